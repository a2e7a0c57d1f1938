"""The registered queries ``opN_<name>``: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.llm import (
    chat, decontaminate, hamming_search, hard_negatives, jaccard_join, lattice_lm, lexical_search,
    pii, secrets, sentencepiece_codec, simhash, toxicity, warc)
from tallyfold.llm.common import ship
from tallyfold.sources.tables import scope, working_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        with scope(spark) as job:  # what the operator stages goes when its result is written
            return job.keep(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document by kind, and the spans that learned contexts add."""
    found = pii.personal_data(documents(spark, sf_dir))
    base = F.concat(*pii.KINDS)
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        digest(span_text(base)).alias("base_sha256"),
        span_text(F.concat(base, pii.CONTEXT)).alias("spans"))


#: A conversation whose texts hold marker strings and a backslash.
ESCAPED = "\\### Assistant: </turn> ok"


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of marker strings, formatted, checked and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ESCAPED).alias("text"))
    back = chat.read_back(chat.format_conversations(rows.unionByName(own)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        digest(turns).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        digest(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad_turn")


def _escaped_sql(text: str) -> str:
    for plain, code in (("\\", "\\\\"), *((m, f"\\{k}") for k, m in enumerate(chat.CHAT.markers))):
        text = f"replace({text}, '{plain}', '{code}')"
    return text


_MARKER_CHARS = sum(map(len, chat.CHAT.markers))
_FINALS = ", ".join(f"'{role}'" for role in chat.CHAT.finals)
ORACLES["op2_chat_formatting"] = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '{ESCAPED}'
  FROM range(2) r(n)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS step
  FROM given),
allowed(state, role) AS (VALUES {", ".join(
    f"('{state}', '{role}')" for state, after in chat.CHAT.steps.items() for role in after)}),
-- a refused role leaves the state as it was: the last role that the machine took
w(conv_id, step, state, bad) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '{chat.CHAT.start}', NULL::BIGINT FROM placed
  UNION ALL
  SELECT w.conv_id, w.step + 1, CASE WHEN a.role IS NULL THEN w.state ELSE p.role END,
         coalesce(w.bad, CASE WHEN a.role IS NULL THEN w.step END)
  FROM w JOIN placed p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.step = w.step
  LEFT JOIN allowed a ON a.state = w.state AND a.role = p.role),
walk AS (SELECT conv_id, arg_max(state, step) AS state, max(bad) AS bad FROM w GROUP BY conv_id),
formatted AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY step)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY step) FILTER (role = 'assistant'), '') AS loss,
         sum(length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + {_MARKER_CHARS})::BIGINT
           AS formatted_chars
  FROM placed GROUP BY conv_id)
SELECT f.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars, bad IS NULL AND state IN ({_FINALS}) AS valid,
       bad::INTEGER AS first_bad_turn
FROM formatted f JOIN walk k ON f.conv_id IS NOT DISTINCT FROM k.conv_id"""
#: The date of the archive's records.
WARC_DATE = "2024-01-31T00:00:00Z"


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as an archive and read back, with digests of the records."""
    folder = f"{working_dir(spark)}/archive"
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder, WARC_DATE)
    return warc.read(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        digest(F.col("record")).alias("record_sha256"),
        digest(F.col("original")).alias("original_sha256"))


ORACLES["op4_warc"] = f"""
WITH given AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
         octet_length(encode(coalesce(html, '')))::BIGINT AS bytes FROM pages),
judged AS (
  SELECT *, first_value(page_id) OVER same AS smallest, first_value(url) OVER same AS first_url
  FROM given WINDOW same AS (PARTITION BY html ORDER BY page_id)),
typed AS (
  SELECT *, bytes >= {warc.SMALLEST_REVISIT} AND page_id <> smallest AS revisit,
    concat_ws(chr(13) || chr(10), 'HTTP/1.1 200 OK', 'Content-Type: text/html; charset=UTF-8',
              'Content-Length: ' || bytes, '', '') AS http FROM judged),
made AS (
  SELECT *, concat_ws(chr(13) || chr(10), 'WARC/1.1',
      'WARC-Type: ' || CASE WHEN revisit THEN 'revisit' ELSE 'response' END,
      'WARC-Record-ID: <urn:page:' || page_id || '/' || md5(url || chr(10) || digest) || '>',
      'WARC-Date: {WARC_DATE}', 'WARC-Target-URI: ' || replace(replace(replace(
        url, '\\', '\\\\'), chr(13), '\\r'), chr(10), '\\n'),
      'WARC-Payload-Digest: sha256:' || digest,
      CASE WHEN revisit THEN 'WARC-Profile: '
        || 'http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' END,
      CASE WHEN revisit THEN 'WARC-Refers-To: <urn:page:' || smallest || '/'
        || md5(first_url || chr(10) || digest) || '>' END,
      'Content-Type: application/http; msgtype=response',
      'Content-Length: ' || (length(http) + CASE WHEN revisit THEN 0 ELSE bytes END), '', http)
      AS head FROM typed)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN smallest END AS refers_to,
       sha256(head || CASE WHEN revisit THEN '' ELSE html END) AS record_sha256,
       sha256(head || html) AS original_sha256
FROM made"""


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: four-word shingles, four bits."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
                        .alias("fingerprint"), "component_id")


@query
def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document by the word model and by the lattice model."""
    return lattice_lm.scores(documents(spark, sf_dir), PIECE_MODEL)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a classifier trained on the rows that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(documents(spark, sf_dir).select("doc_id", "text"), labels).select(
        "doc_id", "toxicity.*")


@query
def op7_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all sign codes for each twentieth row."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes = hamming_search.sign_codes(vectors, "vec_id", "embedding")
    return hamming_search.top_k(codes, F.col("id") % 20 == 0, k=10)


ORACLES["op7_hamming_top_k"] = """
WITH bits AS (
  SELECT vec_id, list_sum(list_transform(range(len(embedding)), lambda i:
         CASE WHEN embedding[i + 1] > 0 THEN (1::HUGEINT << i::HUGEINT) ELSE 0::HUGEINT END))::HUGEINT
         AS code FROM embeddings),
near AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, bit_count(xor(q.code, r.code))::BIGINT
         AS distance FROM bits q CROSS JOIN bits r WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank,
         neighbor_id, distance FROM near)
SELECT query_id, rank::INTEGER AS rank, neighbor_id, distance FROM ranked WHERE rank <= 10"""


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of secrets in every document, and runs of few characters per token."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.secret_spans(docs, RANKS, PATTERN).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] != secrets.RANDOM)
    return found.select(
        "doc_id",
        *[count_kind("secrets", kind) for kind in secrets.KINDS],
        digest(span_text(base)).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document lies in benchmark windows, and its longest match."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminate.verdicts(documents(spark, sf_dir).select("doc_id", "text"), items)
    return judged.select("doc_id", *[f"verdict.{c}" for c in (
        "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_start")])


def _words_sql(table: str, key: str) -> str:
    return (f"(SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})")


ORACLES["op9_decontamination"] = f"""
WITH worded AS {_words_sql("documents", "doc_id")},
d AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM worded),
i AS (SELECT item_id, len(w) AS size, generate_subscripts(w, 1) AS p, unnest(w) AS word
      FROM {_words_sql("benchmark", "item_id")}),
met AS (SELECT doc_id, item_id, size, d.p AS p, d.p - i.p AS lag FROM d JOIN i USING (word)),
runs AS (
  SELECT doc_id, item_id, size, min(p) AS start, count(*) AS n
  FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, lag ORDER BY p) AS island
        FROM met) GROUP BY doc_id, item_id, size, lag, island),
longest AS (SELECT doc_id, max(n) AS longest, min(start) FILTER (n = most) - 1 AS longest_start
  FROM (SELECT *, max(n) OVER (PARTITION BY doc_id) AS most FROM runs) GROUP BY doc_id),
covered AS (SELECT * FROM runs WHERE n >= least(13, size)),
hit AS (SELECT doc_id, count(DISTINCT place)::BIGINT AS n_hit FROM (
  SELECT doc_id, unnest(range(start, start + n)) AS place FROM covered) GROUP BY doc_id),
items AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM covered) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(longest, 0)::INTEGER AS longest, longest_start::INTEGER AS longest_start
FROM worded LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
LEFT JOIN longest USING (doc_id)"""


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return (sentencepiece_codec.encode_and_decode(docs, PIECE_MODEL)
            .select("doc_id", "codec.n_tokens", "codec.ids_sha256", "codec.decoded_sha256"))


@query
def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: four-word shingles, similarity of 0.85 or more."""
    return jaccard_join.jaccard_components(documents(spark, sf_dir), shingle=4, percent=85)


ORACLES["op11_ngram_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(words) - 2, 2)),
         lambda i: array_to_string(words[i:i + 3], ' ')))) AS shingles
  FROM worded WHERE len(words) > 0),
classes AS (SELECT shingles, min(doc_id) AS class FROM sets GROUP BY shingles),
tokens AS (SELECT class, len(shingles) AS n, unnest(shingles) AS shingle FROM classes),
links AS (
  SELECT a.class AS u, b.class AS v FROM tokens a JOIN tokens b USING (shingle)
  WHERE a.class <> b.class GROUP BY a.class, b.class, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (SELECT class AS u, class AS v FROM classes
  UNION SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v),
components AS (SELECT u AS class, min(v) AS component_id FROM reached GROUP BY u)
SELECT d.doc_id, coalesce(len(s.shingles), 0)::BIGINT AS n_shingles,
       coalesce(k.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN classes c ON c.shingles = s.shingles
LEFT JOIN components k ON k.class = c.class"""


@query
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring of all documents for each benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.ranked_search(documents(spark, sf_dir), items, k=10)


ORACLES["op12_ranked_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
i AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text,
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
size AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS terms
         FROM d WHERE len(terms) > 0),
m AS (SELECT doc_id, 10 + (90 * len(d.terms) * size.docs) // size.terms AS m FROM d, size
      WHERE len(d.terms) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d)
       GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM df, size),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id)
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER
         AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten negatives for each of five positives of every anchor, the rows with an id divisible by 100."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0, label=label)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding,
         lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
         ORDER BY s.score DESC, s.other)::INTEGER AS rank, s.other AS negative_id,
         p.positive_score, s.score AS negative_score
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT * FROM ranked WHERE rank <= 10"""
