"""SimHash fingerprints of word shingles and near-duplicate groups by tiled exact comparison.

Equal fingerprints are one row. The distinct ones are dealt into blocks by their bit counts, and every pair
of blocks whose bit counts can lie within the radius is a cell of its own, so that each such pair of
fingerprints meets in exactly one task of bounded size. Inside a cell both blocks are ordered by the bit counts of their 16-bit parts and cut into tiles; tile pairs
whose bit counts differ beyond the radius are skipped, the others are compared by exclusive-or and bit
counts. A cell returns a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import arrow_udf

from tallyfold.llm.common import fresh, parts, staged, text_or_empty
from tallyfold.llm.components import connected

TILE = 512
BLOCKS = 1_000, 32, 1 << 20  # rows of a small block, most blocks, rows of the largest block
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash: a bit is 1 if over half the shingle hashes have it; no words: 0."""
    words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    n = len(words) - width + 1
    starts, ends = starts[:n].tolist(), ends[width - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, n, SHINGLES_AT_ONCE):
        some = range(k, min(n, k + SHINGLES_AT_ONCE))
        hashes = np.fromiter((digest(joined[starts[i]:ends[i]], seed) for i in some), ">u8",
                             len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str | Column = "text", shingle: int = 4) -> DataFrame:
    """``docs`` with a long column ``fingerprint`` (underscores if taken); null text: as empty, 0."""

    @arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch), np.uint64,
                                 len(batch))
            yield pa.array(values.view(np.int64))

    return docs.withColumn(fresh(docs, "fingerprint"), simhash(text_or_empty(text)))


def _root(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    up = parent[nodes]
    while (parent[up] != up).any():
        up = parent[up]
    return up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; roots are the smallest members."""
    while len(a):
        a, b = _root(parent, a), _root(parent, b)
        apart = a != b
        a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(parent, b, a)


def _tiles(codes: np.ndarray, tile: int):
    """Codes in order of their parts' bit counts, and the least and largest counts in each tile."""
    codes = np.ascontiguousarray(codes)
    bits = np.bitwise_count(codes.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    by = np.lexsort(bits.T[::-1])
    edges = np.arange(0, len(codes), tile)
    return (codes[by], np.minimum.reduceat(bits[by], edges), np.maximum.reduceat(bits[by], edges))


def links(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = TILE) -> np.ndarray:
    """Spanning forest, as rows (code, root), of the pairs at ``radius`` bits or fewer.

    Pairs have a code of ``left`` and one of ``right``, or both of ``left`` if that is None.
    """
    a, a_low, a_high = _tiles(left, tile)
    b, b_low, b_high = (a, a_low, a_high) if right is None else _tiles(right, tile)
    nodes = a if right is None else np.concatenate([a, b])
    shift = 0 if right is None else len(a)
    parent = np.arange(len(nodes))
    for i in range(len(a_low)):
        gap = np.maximum(np.maximum(b_low - a_high[i], a_low[i] - b_high), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        x = a[i * tile:(i + 1) * tile, None]
        for j in (near if right is not None else near[near >= i]).tolist():
            close = np.bitwise_count(x ^ b[None, j * tile:(j + 1) * tile]) <= radius
            if close.any():
                p, q = np.nonzero(close)
                _unite(parent, p + i * tile, q + (j * tile + shift))
    root = _root(parent, np.arange(len(nodes)))
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]], axis=1)


def deal_by_bits(counts: dict[int, int], size: int, radius: int) -> list[tuple[int, int, int, int]]:
    """For each bit count from 0 to 64: (first block, blocks, first and last block within ``radius``).

    Codes of neighbouring bit counts share a block up to about ``size`` codes; one bit count with more
    has several blocks, among which its codes are dealt by hash.
    """
    groups: list[list[int]] = []  # least and largest bit count, codes
    for bits in range(65):
        if groups and groups[-1][2] + counts.get(bits, 0) <= size:
            groups[-1][1:] = [bits, groups[-1][2] + counts.get(bits, 0)]
        else:
            groups.append([bits, bits, counts.get(bits, 0)])
    blocks = [max(1, -(-n // size)) for _, _, n in groups]
    first = [sum(blocks[:i]) for i in range(len(blocks))]
    out = []
    for i, (low, high, _) in enumerate(groups):
        near = [k for k, (a, b, _) in enumerate(groups) if a <= high + radius and b >= low - radius]
        out += [(first[i], blocks[i], first[near[0]], first[near[-1]] + blocks[near[-1]] - 1)] * (
            high - low + 1)
    return out


def near_links(codes: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that connect what the pairs within ``radius`` connect, for distinct ``code``."""
    bits = F.bit_count("code")
    counts = {r["bits"]: r["n"] for r in codes.groupBy(bits.alias("bits")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # 65 rows at most
    total = sum(counts.values())
    places = deal_by_bits(counts, -(-total // parts(total, *BLOCKS)) or 1, radius)
    first, n, low, high = (F.get(F.lit(list(column)), bits) for column in zip(*places))
    block = first + F.pmod(F.xxhash64("code"), n)
    # pairs of blocks whose bit counts differ by more than the radius are not made
    dealt = codes.select("code", block.alias("block"), F.explode(F.sequence(
        low.cast("long"), high.cast("long"))).alias("other")).select(
        F.least("block", "other").alias("row"), F.greatest("block", "other").alias("column"),
        (F.col("block") <= F.col("other")).alias("left"), "code")

    def compare(cell: pa.Table) -> pa.Table:
        values = cell["code"].to_numpy().view(np.uint64)
        left = cell["left"].to_numpy(zero_copy_only=False)
        same = cell["row"][0].as_py() == cell["column"][0].as_py()
        found = np.zeros((0, 2), np.uint64)
        if same or 0 < left.sum() < len(left):
            found = links(values[left], None if same else values[~left], radius)
        found = found.view(np.int64)
        return pa.table({"u": found[:, 0], "v": found[:, 1]})

    ends = {(a, k, last) for a, k, _, last in places}  # a cell is work for a task
    cells = sum(last - block + 1 for a, k, last in ends for block in range(a, a + k))
    return dealt.repartition(cells, "row", "column").groupBy("row", "column").applyInArrow(
        compare, "u long, v long")


def groups(prints: DataFrame, best: Column, radius: int = 4) -> DataFrame:
    """For each ``fingerprint`` of ``prints``: (fingerprint, best), the least ``best`` of its group.

    Groups are the connected components of fingerprints that differ in ``radius`` bits or fewer.
    """
    distinct = staged(prints.groupBy("fingerprint").agg(F.min(best).alias("best")), "distinct")
    pairs = staged(near_links(distinct.select(F.col("fingerprint").alias("code")), radius), "links")
    root = connected(pairs).withColumnRenamed("node", "fingerprint")
    joined = distinct.join(root, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "best")
    least = joined.groupBy("root").agg(F.min("best").alias("best"))
    return joined.drop("best").join(least, "root").select("fingerprint", "best")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row for each row of ``docs``: id_column, fingerprint (long), component_id.

    component_id is the least id that links reach, itself included; null ids count only where a
    group has no other. Texts without words (null, empty, white space) have fingerprint 0 and link
    like any other. Repeated rows are members like others; an empty table gives an empty one.
    """
    prints = staged(fingerprints(docs.select(id_column, text_or_empty(text).alias("text_")),
                                 "text_", shingle).select(id_column, "fingerprint"), "prints")
    found = groups(prints, F.col(id_column), radius).withColumnRenamed("best", "component_id")
    return prints.join(found, "fingerprint").select(id_column, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4,
                radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with the least id of their group, one row of each group.

    Where that id is repeated or null in the group, any one of those rows stays. Columns stay.
    """
    row, code = fresh(docs, "row_number"), fresh(docs, "fingerprint")
    table = staged(fingerprints(docs, text, shingle).withColumn(
        row, F.monotonically_increasing_id()), "rows")
    prints = table.select(F.col(code).alias("fingerprint"), F.struct(
        F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"),
        F.col(row).alias("row")).alias("best"))
    kept = groups(prints, F.col("best"), radius).select(F.col("best.row").alias(row)).distinct()
    return table.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
