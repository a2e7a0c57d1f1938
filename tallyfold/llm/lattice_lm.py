"""Language-model scores from the lattice of all subword segmentations.

The pieces are those of an existing vocabulary. Its scores are ranks; as prior a piece of rank r gets a
probability in proportion to 1 / (r + RANK_SHIFT). Under the prior all segmentations of every training
word are weighted, and the expected piece counts, with the prior as pseudo-counts, are the weights of
the next round; those of the last round are the model's probabilities. A text's probability is the sum over all its segmentations, times that of its end:
no piece crosses a word, so it is the product of the words' sums, which a forward recursion gives.
Beside it stands the add-one word model (``base_score``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import staged, text_or_empty

SPACE, BREAK = "▁", "\n"
RANK_SHIFT, PRIOR_COUNT = 50.0, 10_000.0
HELD_WORDS = 300_000     # of a task's counts before they are passed on
FREQUENT = 100_000       # a word with this part of all tokens is frequent: at most so many words are
ROUNDS = 2               # of expected counts; a third one gains little
LOG10 = np.log(10)


class Lattice:
    """Edges and sums of the segmentations of words; weights are natural logs.

    Weight k belongs to piece k of the vocabulary (bytes for characters that no piece is), the last
    one to the end of a text.
    """

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size, order = library.get_piece_size(), {}
        self.byte_ids = np.zeros(256, np.int64)
        self.length = np.zeros(self.size, np.int64)
        self.automaton = ahocorasick.Automaton()
        for i in range(self.size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                order[i] = 1.0  # behind all pieces
            elif not (library.is_control(i) or library.is_unknown(i) or BREAK in piece):
                self.automaton.add_word(piece, i)
                self.length[i] = len(piece)
                order[i] = -library.get_score(i)
        self.automaton.make_automaton()
        worst = max(order.values())
        rank = np.full(self.size + 1, np.inf)
        for i, score in order.items():
            rank[i] = worst + 1 if library.is_byte(i) else score
        by = np.argsort(rank[:-1], kind="stable")
        place = np.full(self.size + 1, np.inf)
        place[by] = np.where(np.isfinite(rank[by]), np.arange(self.size), np.inf)
        place[-1] = 0  # the end, as likely as the first piece
        weight = 1 / (place + RANK_SHIFT)
        self.prior = weight / weight.sum()
        self.known = np.zeros(0x110000, bool)
        chars = {c for i in order if self.length[i] for c in library.id_to_piece(i)}
        self.known[[ord(c) for c in chars if c in self.automaton]] = True

    def edges(self, words: list[str]):
        """(starts, ends, from, to, weight index, extra): nodes are places in the joined words.

        Weight indices from ``size + 1`` on stand for the characters in ``extra``, spelt by bytes.
        """
        joined = SPACE + (BREAK + SPACE).join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(sizes + 1) - sizes - 1
        found = list(self.automaton.iter(joined))
        end, index = (np.fromiter((f[k] for f in found), np.int64, len(found)) for k in (0, 1))
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        odd = np.flatnonzero(~self.known[codes] & (codes != ord(BREAK)))
        extra, which = np.unique(codes[odd], return_inverse=True)
        to = np.concatenate([end + 1, odd + 1])
        begin = np.concatenate([end + 1 - self.length[index], odd])
        weight = np.concatenate([index, which + self.size + 1])
        return starts, starts + sizes, begin, to, weight, extra

    def weights(self, log_p: np.ndarray, extra: np.ndarray) -> np.ndarray:
        spelt = [log_p[self.byte_ids[list(chr(c).encode())]].sum() for c in extra.tolist()]
        return np.concatenate([log_p, spelt])

    @staticmethod
    def _sums(nodes: int, seeds: np.ndarray, source, target, weight, steps) -> np.ndarray:
        """Log of the sums over paths from the seeds; edges go by ``steps``, then by target."""
        total = np.full(nodes, -np.inf)
        total[seeds] = 0.0
        by = np.lexsort((target, steps))
        source, target, weight, steps = source[by], target[by], weight[by], steps[by]
        cuts = np.flatnonzero(np.diff(steps, prepend=-1))
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(steps)]):
            values = total[source[low:high]] + weight[low:high]
            first = np.flatnonzero(np.diff(target[low:high], prepend=-1))
            total[target[low:high][first]] = np.logaddexp.reduceat(values, first)
        return total

    def forward(self, words: list[str], log_p: np.ndarray):
        """(log probability of every word, and what ``expected`` needs)."""
        starts, ends, begin, to, index, extra = self.edges(words)
        weight = self.weights(log_p, extra)[index]
        word = np.searchsorted(starts, begin, side="right") - 1
        nodes = int(ends[-1]) + 1
        total = self._sums(nodes, starts, begin, to, weight, to - starts[word])
        return total[ends], (starts, ends, begin, to, index, extra, weight, word, nodes, total)

    def expected(self, words: list[str], counts: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Expected uses of every weight over the words, each taken ``counts`` times."""
        whole, (_, ends, begin, to, index, extra, weight, word, nodes, total) = self.forward(
            words, log_p)
        back = self._sums(nodes, ends, to, begin, weight, ends[word] - begin)
        share = np.exp(total[begin] + weight + back[to] - whole[word]) * counts[word]
        uses = np.bincount(index, share, self.size + 1 + len(extra))
        spelt = uses[self.size + 1:]
        uses = uses[:self.size + 1]
        for c, n in zip(extra.tolist(), spelt.tolist()):
            np.add.at(uses, self.byte_ids[list(chr(c).encode())], n)
        return uses


def words_of(text: str) -> list[str]:
    """Lower-cased (A-Z) words between ASCII white space, whole text."""
    return [w.decode() for w in text.encode().lower().split()]


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, count): occurrences in training rows; words of other rows alone have 0."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            rows = [pa.array(list(seen), pa.binary()).cast(pa.string()),
                    pa.array(list(seen.values()), pa.int64())]
            batch = pa.RecordBatch.from_arrays(rows, ["word", "count"])
            seen.clear()
            return batch

        for batch in batches:
            for text, held in zip(batch["text"], batch["held_out"].to_pylist()):
                words = text.as_py().encode().lower().split()
                if held:
                    for w in set(words):
                        seen.setdefault(w, 0)
                else:
                    seen.update(words)
                if len(seen) >= HELD_WORDS:
                    yield passed_on()
        yield passed_on()

    return docs.select("text", "held_out").mapInArrow(count, "word string, count long").groupBy(
        "word").agg(F.sum("count").alias("count"))


def _reweighted(words: DataFrame, ends: int, lattice, weights: np.ndarray) -> np.ndarray:
    """Log probabilities from the training words' expected counts under ``weights``."""
    sent = words.sparkSession.sparkContext.broadcast(weights)

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lattice(lattice.value)
        total = np.zeros(model.size + 1)
        for batch in batches:
            if batch.num_rows:
                total += model.expected(batch["word"].to_pylist(), batch["count"].to_numpy(),
                                        sent.value)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

    summed = words.where("count > 0").mapInArrow(uses, "piece long, uses double").groupBy(
        "piece").agg(F.sum("uses").alias("uses")).toArrow()  # a row for each piece
    total = Lattice(lattice.value).prior * PRIOR_COUNT
    total[summed["piece"].to_numpy()] += summed["uses"].to_numpy()
    total[-1] += ends
    with np.errstate(divide="ignore"):
        return np.log(total / total.sum())


def _trained(words: DataFrame, ends: int, lattice, rounds: int) -> np.ndarray:
    """Log probabilities after ``rounds`` of reweighting, from the prior on."""
    with np.errstate(divide="ignore"):
        log_p = np.log(Lattice(lattice.value).prior)
    for _ in range(rounds):
        log_p = _reweighted(words, ends, lattice, log_p)
    return log_p


def _scored_words(words: DataFrame, lattice, log_p) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lattice(lattice.value)
        for batch in batches:
            if batch.num_rows:
                values = model.forward(batch["word"].to_pylist(), log_p.value)[0] / LOG10
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)],
                                                 ["word", "count", "log_p"])

    return words.select("word", "count").mapInArrow(score, "word string, count long, log_p double")


def scores(docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text",
           folds: int = 7, held_fold: int = 2, frequent: int = FREQUENT,
           rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: id_column, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the whole text and its end).

    A row is held out if crc32(id as text; null: empty) mod ``folds`` is ``held_fold``; the others
    train both models. Null and empty texts are the end alone. Without training rows the base model
    is uniform over its one unseen token and the piece model is the prior. Repeated rows count and
    score like others; an empty table gives an empty one.

    Words that make up a ``frequent``-th of all tokens, at most so many, are broadcast; a text's other
    words are joined to the word table by shuffle, so no common word meets in one task.
    """
    spark = docs.sparkSession
    fold = F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(folds))
    typed = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"),
                        (fold == held_fold).alias("held_out"))
    with open(model_path, "rb") as file:
        lattice = spark.sparkContext.broadcast(file.read())
    counted = staged(_word_counts(typed), "counts")
    ends = typed.where("NOT held_out").count()
    total, distinct = counted.agg(F.coalesce(F.sum("count"), F.lit(0)),
                                  F.count_if(F.col("count") > 0)).first()
    total, distinct = total + ends, distinct + (ends > 0)
    log_p = _trained(counted, ends, lattice, rounds)
    words = staged(_scored_words(counted, lattice, spark.sparkContext.broadcast(log_p)), "words")
    common = F.col("count") > total / frequent
    table = words.where(common).toArrow()  # fewer than ``frequent`` rows
    top = spark.sparkContext.broadcast(dict(zip(
        table["word"].to_pylist(), zip(table["count"].to_pylist(), table["log_p"].to_pylist()))))
    end_score = float(log_p[-1] / LOG10)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = {w.encode(): (np.log10(c + 1), p) for w, (c, p) in top.value.items()}
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for value in batch["text"]:
                tokens = value.as_py().encode().lower().split()
                known, base, log = int(ends > 0), float(np.log10(ends + 1)), end_score
                rare = {}
                for word, n in Counter(tokens).items():
                    hit = known_words.get(word)
                    if hit is None:
                        rare[word] = n
                    else:
                        known, base, log = known + n, base + n * hit[0], log + n * hit[1]
                for column, x in zip(columns, (len(tokens) + 1, known, base, log,
                                               list(rare.keys()), list(rare.values()))):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()),
                     pa.list_(pa.int64()))
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            arrays[4] = arrays[4].cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["id"], batch["held_out"], *arrays], names)

    names = ["row", "id", "held_out", "n_tokens", "known", "base", "log_p", "rare", "times"]
    kind = typed.schema["id"].dataType.simpleString()
    parts = staged(typed.select(F.monotonically_increasing_id().alias("row"), "id", "held_out",
                                "text").mapInArrow(
        sums, f"row long, id {kind}, held_out boolean, n_tokens long, known long, base double, "
              "log_p double, rare array<string>, times array<long>"), "parts")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("one")).select(
        "row", F.col("one.rare").alias("word"), F.col("one.times").alias("n"))
    joined = rare.join(words.where(~common), "word").groupBy("row").agg(
        F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.col("n") * F.log10(F.col("count") + 1)).alias("more_base"),
        F.sum(F.col("n") * F.col("log_p")).alias("more_log"))
    whole: Column = F.lit(float(np.log10(total + distinct + 1)))
    return parts.join(joined, "row", "left").select(
        F.col("id").alias(id_column), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * whole)
        .alias("base_score"),
        (F.col("log_p") + F.coalesce("more_log", F.lit(0.0))).alias("score"))
