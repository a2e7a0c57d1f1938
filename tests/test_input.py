import csv
import io
import random
from datetime import timedelta
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfold import CLINICAL
from tallyfold.operators.checks import violations
from tallyfold.operators.normalize import normalize, sample_metadata, with_metadata
from tallyfold.operators.composition import composition
from tallyfold.plans.jobs import load
from tallyfold.sources import quoted_lines, tables as store
from tallyfold.sources.tables import published_run
from tallyfold.sources.wide_csv import MALFORMED, UNCASTABLE, InvalidInput, read_wide
from tallyfold.study import METADATA, TABLES, TIME
from tests.conftest import BASE_ROW
from verification.queries import QUERIES


def write_csv(path, rows, columns=CLINICAL.wide_columns):
    lines = [",".join(columns)]
    lines += [",".join("" if r[c] is None else str(r[c]) for c in columns) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [BASE_ROW], tuple(reversed(CLINICAL.wide_columns)))
    row = read_wide(spark, path, CLINICAL).drop(UNCASTABLE, MALFORMED).first().asDict()
    assert row == BASE_ROW


def test_records_with_more_or_fewer_fields_are_found(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [BASE_ROW, {**BASE_ROW, "sample": "long", "monocyte": "5,6"},
                                          {**BASE_ROW, "sample": "ok"}])
    lines = (tmp_path / "a.csv").read_text().splitlines()
    short = lines[1].rsplit(",", 1)[0].replace(BASE_ROW["sample"], "short")
    (tmp_path / "a.csv").write_text("\n".join([*lines, short]) + "\n")
    found = violations(read_wide(spark, path, CLINICAL), CLINICAL).where("rule = 'malformed_row'")
    assert {r.key for r in found.collect()} == {"long", "short"}
    with pytest.raises(InvalidInput, match="more or fewer fields"):
        load(spark, path, str(tmp_path / "out"))
    assert published_run(spark, str(tmp_path / "out/tables")) is None


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of 70 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "70", "spark.sql.files.openCostInBytes": "1"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


PROJECTS = ["two\nlines", "plain", 'a "quoted"\n\nword, and more', "\n", "x" * 300 + "\n" + "y" * 300,
            'ends with a quote"', "comma, only", "one\r\ntwo", *["n"] * 20, "last\n"]


def write_projects(path, ends="\n"):
    """The way any CSV writer does: fields with a break, comma or quote are quoted."""
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, CLINICAL.wide_columns, lineterminator=ends)
        writer.writeheader()
        for i, project in enumerate(PROJECTS):
            writer.writerow({**BASE_ROW, "sample": f"s{i}", "project": project})


def projects(frame):
    assert violations(frame, CLINICAL).where("rule = 'malformed_row'").count() == 0
    return {r["sample"]: r.project for r in frame.collect()}


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_quoted_line_breaks(spark, tmp_path, ends):
    write_projects(tmp_path / "a.csv", ends)
    assert projects(read_wide(spark, str(tmp_path / "a.csv"), CLINICAL)) == {
        f"s{i}": p for i, p in enumerate(PROJECTS)}


def test_quoted_line_breaks_over_many_blocks(spark, tmp_path, small_blocks):
    for name in ("a", "b"):
        write_projects(tmp_path / f"{name}.csv")
    (tmp_path / "empty.csv").write_text("")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 40
    got = read_wide(spark, str(tmp_path), CLINICAL)
    assert got.count() == 2 * len(PROJECTS)
    assert projects(got) == {f"s{i}": p for i, p in enumerate(PROJECTS)}


def test_lone_quotes_are_characters(spark, tmp_path, small_blocks):
    """A quote that doesn't start its field opens nothing, as the line's other fields show."""
    rows = [{**BASE_ROW, "sample": "a", "project": 'six" wide'}, {**BASE_ROW, "sample": "b"},
            {**BASE_ROW, "sample": "c", "project": 'o"ne"'}, {**BASE_ROW, "sample": "d"}]
    plain = {"a": 'six" wide', "b": BASE_ROW["project"], "c": 'o"ne"', "d": BASE_ROW["project"]}
    assert projects(read_wide(spark, write_csv(tmp_path / "a.csv", rows), CLINICAL)) == plain
    rows.append({**BASE_ROW, "sample": "e", "project": '"two\nlines"'})
    assert projects(read_wide(spark, write_csv(tmp_path / "b.csv", rows), CLINICAL)) == {
        **plain, "e": "two\nlines"}


@pytest.mark.parametrize("bad,message", [
    ('"never closed', "isn't closed"), ("\n".join(["broken,line", '"x\ny",1']), None)])
def test_unclosed_quotes(spark, tmp_path, small_blocks, bad, message):
    path = write_csv(tmp_path / "a.csv", [BASE_ROW] * 6)
    with open(path, "a") as out:
        out.write(bad)
    if message is None:
        found = violations(read_wide(spark, path, CLINICAL), CLINICAL)
        assert found.where("rule = 'malformed_row'").count() == 2
    else:
        with pytest.raises(InvalidInput, match=message):
            read_wide(spark, path, CLINICAL)


def test_records_beyond_the_bound_are_refused(spark, tmp_path, small_blocks, monkeypatch):
    path = write_csv(tmp_path / "a.csv", [BASE_ROW, {**BASE_ROW, "project": '"' + "z\n" * 300 + '"'}])
    assert read_wide(spark, path, CLINICAL).count() == 2
    monkeypatch.setattr(quoted_lines, "MAX_RECORD", 400)
    with pytest.raises(InvalidInput, match="a record of"):
        read_wide(spark, path, CLINICAL)
    walk = quoted_lines._Walk(1)
    for line in ["z"] * 300:
        walk.take(line)
    assert walk.rest() == [("middle", None)] and len(walk.held) < 300  # within a block, too


def test_walks_equal_the_csv_module():
    """Random texts cut anywhere between lines: the records are those of Python's reader."""
    rng = random.Random(6)
    for _ in range(300):
        rows = [["".join(rng.choice(['a', '"', ",", "\n", ""]) for _ in range(rng.randrange(6)))
                 for _ in range(2)] for _ in range(rng.randrange(1, 8))]
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerows([["h", "i"], *rows])
        lines = text.getvalue().split("\n")[:-1]
        cuts = sorted({0, *rng.choices(range(1, len(lines) + 1), k=3)}) + [len(lines)]
        parts = [row for a, b in zip(cuts, cuts[1:]) if a < b
                 for row in quoted_lines._block("f", a, iter(lines[a:b]), "h,i")]
        ends = pa.table({name: [row[i] for row in parts if row[3] == "end" or row[2:4] == (1, "lead")]
                         for i, name in ((0, "file"), (1, "block"), (2, "state"), (3, "kind"),
                                         (5, "after"))})
        states = {r["block"]: r for r in quoted_lines.chain_blocks(ends).to_pylist()}
        found, open_ = [], {}
        for _, block, state, kind, value, _ in parts:
            before = states[block]["before"]
            if kind != "end" and state in (quoted_lines.EITHER, before):
                if kind == "record":
                    found.append(value)
                else:
                    key = block if kind == "tail" else states[block]["opened"]
                    open_.setdefault(key, []).append((block, value))
        found += ["\n".join(v for _, v in sorted(p)) for p in open_.values()]
        want = [io.StringIO() for _ in rows]
        for out, row in zip(want, rows):
            csv.writer(out, lineterminator="").writerow(row)
        assert sorted(found) == sorted(out.getvalue() for out in want if out.getvalue().strip())


def test_one_scan_of_a_plain_file(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{**BASE_ROW, "sample": f"s{i}"} for i in range(5)])
    text = spark.read.text(path)
    reads = []
    original = type(spark.read).text
    def counted(self, *args, **options):
        reads.append(args)
        return original(self, *args, **options)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "text", counted)
        assert read_wide(spark, path, CLINICAL).count() == 5
    assert len(reads) == 2 and text.count() == 6  # the first line alone, then all lines once


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write_csv(folder / "a.csv", [BASE_ROW])
    write_csv(folder / "b.csv", [BASE_ROW], tuple(reversed(CLINICAL.wide_columns)))
    with pytest.raises(Exception, match="header"):
        read_wide(spark, str(folder), CLINICAL).collect()


def test_blank_texts_become_null_but_lower_case_none_stays(spark, tmp_path):
    rows = [{**BASE_ROW, "sample": "s1", "response": None, "treatment": "none"},
            {**BASE_ROW, "sample": "s2", "response": "NA", "condition": "None"},
            {**BASE_ROW, "sample": "s3", "response": '""', "sex": "null"}]
    got = {r["sample"]: r for r in read_wide(spark, write_csv(tmp_path / "a.csv", rows),
                                             CLINICAL).collect()}
    assert got["s1"].response is None and got["s1"].treatment == "none"
    assert got["s2"].response is None and got["s2"].condition is None
    assert got["s3"].response is None and got["s3"].sex is None


def test_quoted_commas_and_quotes(spark, tmp_path):
    rows = [{**BASE_ROW, "project": '"a, ""b"""'}]
    path = write_csv(tmp_path / "a.csv", rows)
    assert read_wide(spark, path, CLINICAL).first().project == 'a, "b"'


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="CSV not found"):
        read_wide(spark, str(tmp_path / "none.csv"), CLINICAL)


def test_wrong_columns(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [BASE_ROW], CLINICAL.wide_columns[:-1])
    with pytest.raises(InvalidInput, match="missing columns"):
        read_wide(spark, path, CLINICAL)


@pytest.fixture
def tables(wide_frame):
    return normalize(wide_frame(
        {"sample": "s2", "time_from_treatment_start": 7, "age": 30},
        {"sample": "s1"}, {"sample": "s3", "subject": "sub2", "project": "prj2",
                           "response": None, "treatment": "none"}), CLINICAL)


def test_schemas_and_rows(tables):
    assert {n: df.count() for n, df in tables.items()} == {
        "projects": 2, "subjects": 2, "samples": 3, "cell_counts": 15}
    for name, df in tables.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in TABLES[name]]


def test_subject_attributes_come_from_the_first_sample(wide_frame):
    df = wide_frame({"sample": "b", "time_from_treatment_start": 7, "sex": "F"},
                    {"sample": "c", "sex": None}, {"sample": "d", "sex": "M"})
    subject = normalize(df, CLINICAL)["subjects"].collect()
    assert len(subject) == 1 and subject[0].sex is None  # sample c: time 0, lowest id


def test_metadata_has_its_ten_columns_and_every_sample(tables):
    meta = sample_metadata(tables)
    assert tuple(meta.columns) == METADATA
    rows = {r["sample"]: r for r in meta.collect()}
    assert set(rows) == {"s1", "s2", "s3"} and rows["s3"].project == "prj2"
    assert sorted(sample_metadata(tables, keys_checked=True).collect()) == sorted(meta.collect())


def test_frequencies_with_metadata_have_fourteen_columns(tables):
    counts = tables["cell_counts"].withColumnRenamed("sample_id", "sample")
    joined = with_metadata(composition(counts), sample_metadata(tables))
    assert len(joined.columns) == 14 and joined.count() == 15


def test_publish_shows_the_last_run_only(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    assert store.published_run(spark, out) is None
    for _ in range(2):
        run, folder = store.new_run(out)
        store.write_tables(tables, folder)
        assert store.published_run(spark, out) != folder
        store.publish(spark, out, run)
        assert store.published_run(spark, out) == folder
    back = store.read_tables(spark, store.published_run(spark, out))
    assert back["samples"].count() == 3


def published(out):
    return sorted(p.name for p in (out / store.POINTERS).iterdir() if not p.name.startswith("."))


def test_a_pointer_number_is_taken_once(spark, tmp_path):
    out = str(tmp_path)
    for run in ("first", "second"):
        store.publish(spark, out, run)
    assert not store._create(spark, store._pointer(out, 2), "late")
    assert store._create(spark, store._pointer(out, 3), "third")  # another job's, just before ours
    store.publish(spark, out, "fourth")
    assert store.published_runs(spark, out) == [
        (1, "first"), (2, "second"), (3, "third"), (4, "fourth")]


def test_pruning_keeps_published_runs_whatever_crashed_in_between(spark, tmp_path):
    """A crashed run's folder doesn't count as one of the runs that are kept."""
    out, runs = str(tmp_path), []
    for crashed in (False, False, True, False):
        run, folder = store.new_run(out)
        spark.range(1).write.parquet(f"{folder}/t")
        runs.append(run)
        if not crashed:
            store.publish(spark, out, run)
    store.prune_runs(spark, out, keep=2)
    left = {p.name.removeprefix("run=") for p in tmp_path.glob("run=*")}
    assert left == {runs[1], runs[2], runs[3]}  # the crashed one is young: it may be at work
    assert [run for _, run in store.published_runs(spark, out)] == [runs[1], runs[3]]
    store.prune_runs(spark, out, keep=2, abandoned=timedelta(0))
    assert {p.name.removeprefix("run=") for p in tmp_path.glob("run=*")} == {runs[1], runs[3]}


def test_pruning_leaves_a_run_that_is_still_writing(spark, tmp_path):
    """It started first and is overtaken by three later runs."""
    out = str(tmp_path)
    slow, folder = store.new_run(out)
    spark.range(3).write.parquet(f"{folder}/t")
    for _ in range(3):
        run, other = store.new_run(out)
        spark.range(1).write.parquet(f"{other}/t")
        store.publish(spark, out, run)
        store.prune_runs(spark, out, keep=1)
    assert spark.read.parquet(f"{folder}/t").count() == 3
    store.publish(spark, out, slow)
    assert store.published_run(spark, out) == folder
    store.prune_runs(spark, out, keep=1)
    assert [p.name for p in tmp_path.glob("run=*")] == [f"run={slow}"] and len(published(tmp_path)) == 1


def test_a_scope_deletes_what_it_staged(spark):
    with store.scope(spark) as outer:
        with store.scope(spark) as inner:
            numbers = store.staged(spark.range(10), "numbers")
            plain = spark.range(3)
            assert inner.keep(plain) is plain
            kept = inner.keep(numbers.where("id > 6"))
            gone, stays = numbers.inputFiles(), kept.inputFiles()
        assert kept.count() == 3 and all(outer.folder in f for f in stays)
        last = outer.keep(kept)
    assert last.count() == 3
    for file in [*gone, *stays]:
        assert not Path(file.removeprefix("file:")).exists()
    with pytest.raises(ZeroDivisionError):
        with store.scope(spark) as failed:
            store.staged(spark.range(1), "one")
            raise ZeroDivisionError
    assert not Path(failed.folder).exists()


def test_queries_leave_only_their_result(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    for name in ("boxplots", "value_ranks", "wide_csv_scan", "adjusted_p_values_of_customers"):
        before = set(base.iterdir())
        made = QUERIES[name](spark, "/root/testdata/sf0.001")
        left = set(base.iterdir()) - before
        assert len(left) == 1 and made.count() > 0
        assert [p.name for p in left.pop().iterdir()] == ["result"]


def rows_read(frame):
    """Rows that the file scans of an executed query gave."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    seen, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            seen += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return seen


def test_a_selective_read_leaves_rows_out(spark, tmp_path):
    """By the order of the rows in a file, and by the Bloom filter of a key."""
    wide = spark.range(0, 400_000, 1, 2).selectExpr(
        "concat('s', hash(id), '-', id) AS sample_id", "concat('p', id % 5000) AS subject_id",
        "IF(id % 10 = 3, 'PBMC', 'WB') AS sample_type", f"CAST(id % 3 * 7 AS INT) AS {TIME}")
    tables = {**store.empty_tables(spark), "samples": wide}
    store.write_tables(tables, str(tmp_path))
    back = store.read_tables(spark, str(tmp_path))["samples"]
    chosen = back.where(f"sample_type = 'PBMC' AND {TIME} = 0")
    assert rows_read(chosen) < 120_000 and chosen.count() == 13_334
    assert rows_read(back.where("sample_id = 'no such sample'")) == 0
    one = wide.first().sample_id
    assert rows_read(back.where(F.col("sample_id") == one)) <= 220_000
    plain = str(tmp_path / "plain")
    wide.write.parquet(plain)
    assert rows_read(spark.read.parquet(plain).where(f"sample_type = 'PBMC' AND {TIME} = 0")) == 400_000


def test_read_optional(spark, tmp_path):
    assert store.read_optional(spark, str(tmp_path / "no")) is None
    df = spark.createDataFrame([(1, 1e-5, "x,y")], "a int, b double, c string")
    store.write_table(df, str(tmp_path / "t"), "csv")
    assert store.read_optional(spark, str(tmp_path / "t"), "csv", df.schema).collect() == df.collect()


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = store.shared_dir(spark), store.shared_dir(spark)
    assert first.startswith(base) and first != second
