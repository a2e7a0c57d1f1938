"""Personal data: base shapes, and identifiers that learned contexts give away.

The base shapes are seeds. An identifier run is made of tokens with a digit or an @ that follow each
other; a run that a seed meets induces lexical patterns: the word, and the two words, before it.
Patterns and instances make a graph that is scored in rounds until nothing changes: a pattern by the
share of all its places in the texts, whatever follows there, that lead to a confident instance; an
instance by the patterns that extract it. A run that a base shape matched and refused (a wrong check
digit, a part over 255, a wrong length) is no instance and so counts against its patterns.
High-confidence patterns then give further spans. Only DataFrame functions are used; scores are
grouped sums, combined before each shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import staged, text_or_empty
from tallyfold.operators.skew import lookup_join

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
# The contract's shapes. A match starts at a run's first character or where the match before ended
# (\G), which is where the leftmost one starts; possessive quantifiers keep the work linear.
_LOCAL = r"[A-Za-z0-9._%+-]"
SHAPES = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_SPACE = r"\x20\x09-\x0D"
_TOKEN = rf"[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+"
_RUN = rf"(?<![^{_SPACE}]){_TOKEN}(?:\x20{_TOKEN})*+"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOCATED = "array<struct<start:int,end:int,text:string,before:string>>"
NEAR_CHARS, AT_ONCE = 80, 512
CARD_DIGITS, MIN_SUPPORT, MIN_SCORE, SETTLED = 16, 3, 0.8, 0.001


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(text, rf"[{_SPACE}]+", " ")), " ")


def _last_words(text: Column) -> Column:
    """The last two words (or fewer); only where the near end lacks them, the whole text is split."""
    near = F.when(F.length(text) > NEAR_CHARS, _words(F.right(text, F.lit(NEAR_CHARS))))
    words = _let(near, lambda w: F.when(F.size(w) > 2, w).otherwise(_words(text)))
    return _let(words, lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), 2), " "))


def _located(text: Column, pattern: str, words: bool = False) -> Column:
    """The pattern's matches with code-point positions and the ``words`` between the last match and it.

    The texts between matches give the positions: sums over (gap, match), in blocks so that the
    array that grows is copied once a block.
    """
    def sums(pairs: Column) -> Column:
        def add(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            one = F.struct(start.alias("start"), (start + x["n"]).alias("end"), x["text"],
                           x["before"])
            return F.struct((start + x["n"]).alias("at"),
                            F.concat(state["out"], F.array(one)).alias("out"), state["all"])

        def block(state: Column, number: Column) -> Column:
            start = F.struct(state["at"], F.array().cast(_LOCATED).alias("out"), state["all"])
            return F.aggregate(
                F.slice(pairs, number * AT_ONCE + 1, AT_ONCE), start, add,
                lambda s: F.struct(s["at"], F.concat(s["all"], F.array(s["out"])).alias("all")))

        empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_LOCATED}>").alias("all"))
        numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / AT_ONCE).cast("int"))
        return F.when(F.size(pairs) > 0, F.flatten(F.aggregate(numbers, empty, block)["all"])) \
            .otherwise(F.array().cast(_LOCATED))

    def pair(matches: Column) -> Column:
        gaps = F.when(F.size(matches) > 0, F.split(text, pattern, -1))
        return F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(
            F.length(m).alias("n"), F.length(g).alias("gap"), m.alias("text"),
            (_last_words(g) if words else F.lit("")).alias("before")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(_let(found, lambda m: F.when(F.size(m) > 0, pair(m)).otherwise(
        pair(F.array().cast("array<string>")))), sums)


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"], x["end"]))


def shape_spans(text: Column, kind: str) -> Column:
    """Struct of two arrays of (kind, start, end): the shape's leftmost non-overlapping matches that
    are ``valid``, and those that are ``refused``: a number counts as a refused card from
    CARD_DIGITS digits on."""
    def near(match: Column) -> Column:
        digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
        return digits >= CARD_DIGITS if kind == "card" else F.lit(True)

    found = F.when(F.contains(text, F.lit(_NEEDS[kind])), _located(text, SHAPES[kind])).otherwise(
        F.array().cast(_LOCATED))
    return _let(found, lambda all_: F.struct(
        _spans(F.filter(all_, lambda x: _valid(kind, x["text"])), kind).alias("valid"),
        _spans(F.filter(all_, lambda x: ~_valid(kind, x["text"]) & near(x["text"])), kind).alias(
            "refused")))


def _runs(text: Column, valid: Column, refused: Column) -> Column:
    """Identifier runs, without marks around them, with their patterns, whether a valid span meets them
    (seed), and whether only refused ones do."""
    def meets(spans: Column, start: Column, end: Column) -> Column:
        return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))

    def one(x: Column, back: Callable[[int], Column]) -> Column:
        left = F.length(F.regexp_extract(x["text"], "^[^A-Za-z0-9+]*", 0))
        body = F.regexp_replace(F.substr(x["text"], left + 1), "[^A-Za-z0-9]++$", "")
        start = x["start"] + left
        end = start + F.length(body)
        # tokens are words, too: the last two words are among the two runs before and those between
        words = F.when(F.contains(x["before"], F.lit(" ")), x["before"]).otherwise(F.concat_ws(
            " ", back(2)["text"], back(1)["before"], back(1)["text"], x["before"]))
        patterns = _let(F.reverse(_words(F.lower(words))), lambda w: F.array(
            w[0], F.concat(F.coalesce(F.get(w, F.lit(1)), F.lit("")), F.lit(" "), w[0])))
        return F.struct(
            start.alias("start"), end.alias("end"), F.md5(body).alias("instance"),
            F.length(body).alias("n"), patterns.alias("patterns"),
            meets(valid, start, end).alias("seed"), meets(refused, start, end).alias("refused"))

    found = _let(_located(text, _RUN, words=True), lambda m: F.transform(
        m, lambda x, i: one(x, lambda n: F.get(m, i - n))))
    return F.filter(found, lambda t: (t["n"] > 0) & (t["seed"] | ~t["refused"]))


def pattern_places(texts: Column, docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, places): how often a pattern's words are followed by any token, in all texts."""
    words = F.filter(F.split(F.lower(texts), rf"[{_SPACE}]+"), lambda w: w != "")
    places = docs.select(words.alias("words")).select(F.explode(F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))),
        lambda w, i: F.struct(w.alias("last"), F.coalesce(F.get("words", i - 1), F.lit("")).alias(
            "before")))).alias("at")).select("at.last", "at.before")
    last = patterns.select(F.element_at(F.split("pattern", " "), -1).alias("last")).distinct()
    met = lookup_join(places, staged(last, "last"), "last")
    each = met.select(F.explode(F.array("last", F.concat_ws(" ", "before", "last"))).alias("pattern"))
    return lookup_join(each, patterns.select("pattern"), "pattern").groupBy("pattern").agg(
        F.count(F.lit(1)).alias("places"))


def _pattern_scores(edges: DataFrame, instances: DataFrame) -> DataFrame:
    """(pattern, score, support): the share of a pattern's places that lead to a confident instance, and
    the sum of its instances' confidences."""
    return lookup_join(edges, instances, "instance").groupBy("pattern").agg(
        (F.sum(F.col("n") * F.col("confidence")) / F.max("places")).alias("score"),
        F.sum("confidence").alias("support")).where(
        (F.col("support") >= MIN_SUPPORT) & (F.col("score") >= MIN_SCORE))


def _instance_scores(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """(instance, confidence): one less the chance that all of its patterns are wrong."""
    wrong = F.log(1 - F.least("score", F.lit(0.99)))
    return lookup_join(edges, patterns.select("pattern", "score"), "pattern").groupBy(
        "instance").agg((1 - F.exp(F.sum(wrong))).alias("confidence"))


def good_patterns(occurrences: DataFrame, texts: Column, docs: DataFrame) -> DataFrame:
    """High-confidence (pattern, score, support) from (pattern, instance, seed) occurrences in the
    ``texts`` of ``docs``.

    Seeds keep confidence 1; other instances start at 0 and get theirs from the patterns of the
    round before. A pattern counts with the confidence of MIN_SUPPORT instances and where MIN_SCORE of
    its places lead to confident ones. Confidences never fall, so patterns only join: rounds end when
    none does and the supports together grow by less than SETTLED.
    """
    drawn = staged(occurrences.groupBy("pattern", "instance").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")), "drawn")
    several = staged(drawn.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(
        F.col("instances") >= MIN_SUPPORT), "several")
    places = staged(pattern_places(texts, docs, several), "places")
    edges = staged(lookup_join(drawn, places, "pattern"), "edges")
    seeds = staged(edges.where("seed").select(
        "instance", F.lit(1.0).alias("confidence")).distinct(), "seeds")
    edges = edges.select("pattern", "instance", "n", "places")
    patterns, counted, support = staged(_pattern_scores(edges, seeds), "patterns"), 0, 0.0
    while True:
        seen = patterns.agg(F.count("*"), F.coalesce(F.sum("support"), F.lit(0.0))).first()
        if seen[0] == counted and seen[1] - support < SETTLED:
            return patterns
        counted, support = seen
        instances = staged(seeds.unionAll(_instance_scores(edges, patterns)).groupBy("instance").agg(
            F.max("confidence").alias("confidence")), "instances")
        patterns = staged(_pattern_scores(edges, instances), "patterns")


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id_column, email, ip, card, phone, context.

    Each of the last five is an array of (kind, start, end) by start: the base shapes, and the runs that
    good contexts add beside them. Positions are code points, end exclusive. A null or empty text has
    none; repeated rows and null ids have rows of their own; an empty table gives an empty one.
    """
    plain = docs.select(id_column, text_or_empty(text).alias("text_"))
    found = plain
    for kind in KINDS:
        found = found.withColumn(f"{kind}_found", shape_spans(F.col("text_"), kind))
    valid, refused = (F.concat(*[F.col(f"{kind}_found")[part] for kind in KINDS])
                      for part in ("valid", "refused"))
    base = staged(found.select(
        F.monotonically_increasing_id().alias("row_"), id_column,
        *[F.col(f"{kind}_found")["valid"].alias(f"{kind}_") for kind in KINDS],
        _runs(F.col("text_"), valid, refused).alias("runs_")), "base")
    runs = base.select("row_", F.explode("runs_").alias("t")).select(
        "row_", "t.start", "t.end", "t.instance", "t.seed", F.explode("t.patterns").alias("pattern"))
    patterns = good_patterns(runs.select("pattern", "instance", "seed"), F.col("text_"), plain)
    added = lookup_join(runs.where("not seed"), patterns, "pattern").groupBy("row_").agg(F.sort_array(
        F.collect_set(F.struct(F.lit(CONTEXT).alias("kind"), "start", "end"))).alias("added"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return base.join(added, "row_", "left").select(
        id_column, *[F.col(f"{kind}_").alias(kind) for kind in KINDS],
        F.coalesce("added", none).alias(CONTEXT))
