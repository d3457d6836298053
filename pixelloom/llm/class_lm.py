"""Brown class-based bigram language model: training on a corpus and scoring whole texts (operator 6).

    P(w | v) = P(class(w) | class(v)) * P(w | class(w))

*Counts.*  Word counts of all training documents are made by per-batch partial sums and a grouped sum.
The ``frequent`` most frequent words are symbols of their own, any other word starts with the symbol of its ending.
Bigrams of symbols are counted over all training documents.

*Classes.*  Exchange clustering on the driver moves symbols between classes until a sweep moves none, so that the class bigram
likelihood can't rise by any one of them; its input is bounded by the square of the number of symbols, whatever the size of the
corpus.  Then every other training word is moved on its own: the classes before and after all its occurrences are grouped by word, and it
goes to the class that raises the same likelihood most, all words at once.  The table of words, counts and classes is distributed.
Class bigrams and sizes are counted anew with these classes.  Only words never seen in training have the class of their ending.

*Smoothing.*  A class's words get ``alpha`` each, with one more for an unknown word; class transitions are drawn to the
class frequencies by ``mu`` counts.  Every text ends with an end token, a class of its own, which also is the context
of the first word, so probabilities of texts sum to one.

*Words* are known by 64-bit hashes, so that texts become arrays of numbers in every pass and no table holds strings.

*Scoring.*  Counts and classes of the ``hot`` most frequent words are broadcast (a stated bound).  The other words of
a document are joined with the word table by word, with their places: they are rare by definition, so no key is hot, and the
frequent words, which would be, never enter the shuffle.  ``train_and_score`` looks the words up once for both: the class bigrams of the
training documents and the scores of all come from one table of classes, a byte a token.

Defined cases: a null or empty text is one end token; a null id belongs to training and carries a null id through;
repeated ids are scored row by row; texts of any length are scored whole; without any training document counts
are zero and all words unknown; only the id and text columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelloom.llm.arrow import bound_batches, kind_of, sliced, utf8
from pixelloom.sources.storage import materialise

#: Words with a symbol of their own; symbols of endings; classes besides the end's; broadcast word counts.
FREQUENT, ENDINGS, CLASSES, HOT = 2048, 1023, 48, 150_000
ALPHA, MU = 0.1, 20.0
#: Sweeps after which exchange stops even if words still move (it ends far below on texts).
SWEEPS = 1_000
#: Rows in which a task sends its bigram counts, and words that it counts before it sends them.
PARTS, MEMO_WORDS = 32, 300_000
#: Occurrences that a task keeps before it sends their contexts, and words that are judged at once.
MEMO_CONTEXTS, STEP_WORDS = 2 << 20, 4096

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hash(word: bytes) -> int:
    """How a word is known everywhere: a 64-bit hash, of V words two share one with a probability of V * V / 2**65."""
    return int(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64).view(np.int64)[0])


#: The end token, as the empty word.
END = word_hash(b"")


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of each text, hash of each token, last three bytes of each token as a number) of all texts in a row.

    Tokens are words between ASCII white space, ASCII letters lowered, then one end."""
    raw = b" ".join(texts).lower()
    a = np.frombuffer(b" " + raw + b" ", np.uint8)
    blank = _SPACE[a]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    sizes = np.diff(np.searchsorted(start, begins))
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, raw.split()), np.uint64, len(start)).view(np.int64)
    last = a[end - 1].astype(np.uint32)
    for k in (2, 3):
        last |= np.where(end - start >= k, a[end - k], 0).astype(np.uint32) << np.uint32(8 * (k - 1))
    at = np.arange(len(found)) + np.repeat(np.arange(len(texts)), sizes)
    words, tails = np.full(len(found) + len(texts), END), np.zeros(len(found) + len(texts), np.uint32)
    words[at], tails[at] = found, last
    return sizes + 1, words, tails


def ending(tails: np.ndarray, endings: int) -> np.ndarray:
    """The class of ending, one of ``endings``, of last bytes."""
    return (tails * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % endings


class Known:
    """Hashes of known words with a value for each."""

    def __init__(self, words: list[int] | np.ndarray, values: np.ndarray):
        words = np.asarray(words, np.int64)
        order = np.argsort(words)
        self.keys, self.values = words[order], values[order]

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether the word is known) of each word; a word that isn't has any value."""
        at = np.searchsorted(self.keys, words)
        at[at == len(self.keys)] = 0
        return self.values[at], self.keys[at] == words


def _symbols(frequent: list[int], endings: int) -> Known:
    """Symbols of the frequent words and, the last one, of the end; between them are those of endings."""
    return Known([*frequent, END], np.array([*range(len(frequent)), len(frequent) + endings]))


def symbols(words: np.ndarray, tails: np.ndarray, known: Known, endings: int) -> np.ndarray:
    """Each token's symbol: the frequent words' own, else that of its last three bytes."""
    own, hit = known.find(words)
    return np.where(hit, own, len(known.keys) - 1 + ending(tails, endings))


def _before(line: np.ndarray, end: int) -> np.ndarray:
    """The token before each one; before the first comes an end, as before every text."""
    return np.concatenate(([end], line[:-1]))


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)


def _binaries(data: bytes, sizes: np.ndarray) -> pa.Array:
    """A binary column of values of these sizes that follow each other in ``data``."""
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, size of each value) of a binary column without nulls."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)), np.diff(at)


def held_out(id_col: str | Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, a multiple of ten; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts, the end token among them."""
    bound_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(times)], names=["word", "n"])

        for b in batches:
            found, n = np.unique(coded(utf8(b.column(0)))[1], return_counts=True)
            words = np.concatenate((words, found))
            order = np.argsort(words, kind="stable")
            head = _runs(words[order])
            words, times = words[order][head], np.add.reduceat(np.concatenate((times, n))[order], head) if len(head) else times
            if len(words) > MEMO_WORDS:
                yield batch()
                words, times = words[:0], times[:0]
        yield batch()

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _bigrams(docs: DataFrame, text_col: str, frequent: list[int], endings: int) -> np.ndarray:
    """Counts of (symbol, next symbol) over all texts, each between two end tokens."""
    size = len(frequent) + endings + 1
    rows = -(-size // PARTS)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = "part int, salt int, cells binary, counts binary"

    def pack(part: int, salt: int, dense: np.ndarray) -> tuple:
        at = np.flatnonzero(dense)
        return part, salt, at.astype("<u4").tobytes(), dense[at].astype("<i8" if dense.max(initial=0) > 2**31 else "<i4").tobytes()

    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], names=["part", "salt", "cells", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _symbols(shared.value, endings)
        total = np.zeros(PARTS * rows * size, np.int64)
        for b in sliced(batches):
            _, words, tails = coded(utf8(b.column(0)))
            line = symbols(words, tails, known, endings)
            cells, n = np.unique(_before(line, size - 1) * size + line, return_counts=True)
            total[cells] += n
        salt = TaskContext.get().partitionId() % 16
        for part, own in enumerate(total.reshape(PARTS, -1)):
            yield batch([pack(part, salt, own)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for part, salt, at, n in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                at = np.frombuffer(at, "<u4")
                own = sums.setdefault((part, salt), np.zeros(rows * size, np.int64))
                own[at] += np.frombuffer(n, "<i4" if len(n) == 4 * len(at) else "<i8")
        for (part, salt), own in sums.items():
            yield batch([pack(part, salt, own)])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, schema)
    halfway = counted.repartition("part", "salt").mapInArrow(add, schema).withColumn("salt", F.lit(0))
    out = np.zeros((PARTS, rows * size), np.int64)
    for r in halfway.repartition(PARTS, "part").mapInArrow(add, schema).toLocalIterator():  # PARTS rows, bounded by the symbols
        at = np.frombuffer(r.cells, "<u4")
        out[r.part, at] = np.frombuffer(r.counts, "<i4" if len(r.counts) == 4 * len(at) else "<i8")
    return out.reshape(-1, size)[:size]


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each symbol; the last symbol (the end) keeps a class of its own, the last.

    Symbols are visited by falling frequency; each moves to the class that raises
    sum N(c, d) log N(c, d) - 2 sum N(c) log N(c) most.  It ends with a sweep without a move."""
    size = len(bigrams)
    freq = bigrams.sum(1)
    order = np.argsort(-freq[:-1], kind="stable")
    of = np.empty(size, np.int64)
    of[order] = np.arange(size - 1) % classes
    of[-1] = classes
    member = np.zeros((classes + 1, size))
    member[of, np.arange(size)] = 1
    b = bigrams.astype(np.float64)
    out_of, into = member @ b, b @ member.T  # class -> symbol, symbol -> class
    pairs = out_of @ member.T
    total = pairs.sum(1)
    for _ in range(sweeps):
        moved = 0
        for w in order.tolist():
            if not freq[w]:
                continue
            g, own = of[w], b[w, w]
            right, left = into[w].copy(), out_of[:, w].copy()
            right[g] -= own  # w's neighbours by class, without w itself
            left[g] -= own
            pairs[g] -= right
            pairs[:, g] -= left
            pairs[g, g] -= own
            total[g] -= freq[w]
            base = _f(pairs)
            rows, columns, diagonal = _f(pairs + right) - base, _f(pairs + left[:, None]) - base, np.diagonal(pairs)
            gain = rows.sum(1) + columns.sum(0) - np.diagonal(rows) - np.diagonal(columns)
            gain += _f(diagonal + right + left + own) - _f(diagonal) - 2 * (_f(total + freq[w]) - _f(total))
            k = int(np.argmax(gain[:classes]))
            if gain[k] <= gain[g] + 1e-6:
                k = g
            pairs[k] += right
            pairs[:, k] += left
            pairs[k, k] += own
            total[k] += freq[w]
            if k != g:
                of[w] = k
                out_of[g] -= b[w]
                out_of[k] += b[w]
                into[:, g] -= b[:, w]
                into[:, k] += b[:, w]
                moved += 1
        if not moved:
            break
    return of


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_classes(right: np.ndarray, left: np.ndarray, own: np.ndarray, now: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class that each word (a row) would move to in ``exchange``, given those of all others.

    ``right`` and ``left`` count the classes after and before the word, without the ``own`` times that it follows itself;
    ``pairs`` are class bigrams with every word in its class of ``now``.  The last class, the end's, is none to move to."""
    m, every = np.arange(len(now)), len(pairs)
    k = every - 1
    total, n = pairs.sum(1), right.sum(1) + own
    r, l, d = right[:, :k], left[:, :k], np.diagonal(pairs)[:k]
    r_g, l_g = right[m, now][:, None], left[m, now][:, None]
    gain = np.zeros((len(now), k))
    for counts, cells in ((right, pairs[:k].T), (left, pairs[:, :k])):  # cells[other class, candidate]
        row, at = np.nonzero(counts)
        if len(row):
            x = counts[row, at]
            step = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1))
            gain[row[step]] += np.add.reduceat(_f(cells[at] + x[:, None]) - _f(cells)[at], step)
    to_g, of_g = pairs[:k, now].T, pairs[now, :k]  # candidate -> own class, own class -> candidate
    gain += _f(to_g - l + r_g) - _f(to_g - l) - _f(to_g + r_g) + _f(to_g)
    gain += _f(of_g - r + l_g) - _f(of_g - r) - _f(of_g + l_g) + _f(of_g)
    gain += _f(d + r + l + own[:, None]) - _f(d + r) - _f(d + l) + _f(d)
    gain -= 2 * (_f(total[:k] + n[:, None]) - _f(total[:k]))
    row, column = pairs[now], pairs[:, now].T
    rows, columns = _f(row) - _f(row - right), _f(column) - _f(column - left)
    rows[m, now] = columns[m, now] = 0
    same = pairs[now, now]
    stay = rows.sum(1) + columns.sum(1) + _f(same) - _f(same - right[m, now] - left[m, now] - own) - 2 * (_f(total[now]) - _f(total[now] - n))
    gain[m, now] = stay
    best = gain.argmax(1)
    return np.where(gain[m, best] > stay + 1e-6, best, now)


def _contexts(docs: DataFrame, text_col: str, frequent: list[int], endings: int, of: np.ndarray) -> DataFrame:
    """(word, ending, contexts) of all words that aren't frequent: two bytes an occurrence, the classes before and after it, or the number of classes for the word itself."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, of = shared.value
        known, end, itself = _symbols(frequent, endings), int(of[-1]), int(of[-1]) + 1
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def rows() -> Iterator[pa.RecordBatch]:
            words, kinds, codes = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            order = np.argsort(words, kind="stable")
            head = _runs(words[order])
            times = np.diff(np.append(head, len(words)))
            found = pa.RecordBatch.from_arrays([pa.array(words[order][head]), pa.array(kinds[order][head]), _binaries(codes[order].tobytes(), 2 * times)], names=["word", "ending", "contexts"])
            for i in range(0, found.num_rows, 10_000):
                yield found.slice(i, 10_000)

        for b in sliced(batches):
            _, words, tails = coded(utf8(b.column(0)))
            line = symbols(words, tails, known, endings)
            classes = of[line]
            at = np.flatnonzero((line >= len(frequent)) & (words != END))
            same = np.append(words[1:] == words[:-1], False)  # a text's last word is followed by its end
            before = np.where(same[at - 1] & (at > 0), itself, _before(classes, end)[at])
            after = np.where(same[at], itself, classes[np.minimum(at + 1, len(line) - 1)])
            held.append((words[at], (line[at] - len(frequent)).astype(np.int32), np.stack([before, after], axis=1).astype(np.uint8)))
            if sum(len(x) for x, _, _ in held) > MEMO_CONTEXTS:
                yield from rows()
        if held:
            yield from rows()

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word long, ending int, contexts binary")


def _assigned(contexts: DataFrame, class_of_ending: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """(word, n, class) of the words of ``_contexts``."""
    shared = contexts.sparkSession.sparkContext.broadcast((class_of_ending, pairs))
    every = len(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of_ending, pairs = shared.value
        once = np.full(((every + 1) * (every + 1) * every,), -1, np.int32)  # best classes of words that occur once, by their context

        def judge(words: np.ndarray, kinds: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
            now, n = class_of_ending[kinds], left.sum(1)
            code = (left.argmax(1) * (every + 1) + right.argmax(1)) * every + now
            single = n == 1
            new, first = np.unique(code[single], return_index=True)
            first = np.flatnonzero(single)[first][once[new] < 0]
            at = np.concatenate((np.flatnonzero(~single), first))
            best = np.empty(len(words), np.int32)
            best[at] = best_classes(right[at, :every], left[at, :every], left[at, every], now[at], pairs)
            once[code[first]] = best[first]
            best[single] = once[code[single]]
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64)), pa.array(best)], names=["word", "n", "class"])

        kept = None  # a word that may go on in the next rows, and its counts
        for b in batches:
            if not b.num_rows:
                continue
            names, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            heads = _runs(names)
            flat, sizes = _bytes_of(b.column(2))
            flat, edge = flat.reshape(-1, 2), np.concatenate(([0], np.cumsum(sizes // 2)))
            for lo in range(0, len(heads), STEP_WORDS):
                own = heads[lo : lo + STEP_WORDS]
                to = heads[lo + STEP_WORDS] if lo + STEP_WORDS < len(heads) else b.num_rows
                words, first = names[own], kinds[own]
                group = np.repeat(np.arange(len(own)), np.diff(edge[np.append(own, to)])) * (every + 1)
                sides = np.stack([np.bincount(group + flat[edge[own[0]] : edge[to], i], minlength=len(own) * (every + 1)).reshape(len(own), -1).astype(float) for i in (0, 1)])
                if kept is not None and kept[0][0] == words[0]:
                    sides[:, 0] += kept[2][:, 0]
                elif kept is not None:
                    yield judge(kept[0], kept[1], *kept[2])
                kept = words[-1:], first[-1:], sides[:, -1:].copy()
                if len(words) > 1:
                    yield judge(words[:-1], first[:-1], *sides[:, :-1])
        if kept is not None:
            yield judge(kept[0], kept[1], *kept[2])

    bound_batches(contexts)
    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word long, n long, class int")


@dataclass
class ClassModel:
    """A trained model: ``counts`` (word, n, class) is a table, the rest is bounded by the parameters.  Words are their hashes."""

    counts: DataFrame
    n: int
    distinct: int
    hot: np.ndarray
    """(word, count, class) of the most frequent words and the end"""
    frequent: list[int]
    endings: int
    of: np.ndarray
    """classes of the frequent words, and of the endings for words never seen"""
    transition: np.ndarray | None = None
    """log10 P(class | class before)"""
    spread: np.ndarray | None = None
    """log10 of what a class's word counts plus alpha are divided by"""


def _clustered(docs: DataFrame, text_col: str, frequent: int, endings: int, classes: int, hot: int) -> ClassModel:
    """The word table of the training documents, still without probabilities."""
    bound_batches(docs)
    spark = docs.sparkSession
    seen = materialise(word_counts(docs, text_col), "word-counts")
    n, distinct = seen.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    top = sorted(((r.word, r.n) for r in _most_frequent(seen, hot).collect()), key=lambda x: (-x[1], x[0]))
    ends = dict(top).get(END, 0)
    top = [x for x in top if x[0] != END][:frequent]
    words = [w for w, _ in top]
    bigrams = _bigrams(docs, text_col, words, endings)
    of = exchange(bigrams, classes)
    member = np.zeros((classes + 1, len(of)))
    member[of, np.arange(len(of))] = 1
    own = spark.createDataFrame([(END, ends, classes), *((w, k, int(c)) for (w, k), c in zip(top, of, strict=False))], "word long, n long, class int")
    rest = _assigned(_contexts(docs, text_col, words, endings, of), of[len(words) : -1], member @ bigrams @ member.T)
    counts = materialise(own.unionByName(rest), "word-classes")
    table = {r.word: (r.n, r["class"]) for r in _most_frequent(counts, hot).collect()}
    table.setdefault(END, (0, classes))
    return ClassModel(counts, n, distinct, np.array([(w, *x) for w, x in table.items()], np.int64), words, endings, of)


def _fitted(model: ClassModel, training: DataFrame) -> ClassModel:
    """The model with its probabilities, from the rows of ``_classified`` of the training documents."""
    every = int(model.of[-1]) + 1
    size, kinds = np.zeros(every), np.zeros(every)
    for r in model.counts.groupBy("class").agg(F.sum("n").alias("size"), F.count(F.when(F.col("n") > 0, 1)).alias("kinds")).collect():
        size[r["class"]], kinds[r["class"]] = r["size"], r.kinds
    pairs = _class_pairs(training, every)
    spread = size + ALPHA * (kinds + 1)
    share = spread / spread.sum()
    model.transition = np.log10((pairs + MU * share) / (pairs.sum(1, keepdims=True) + MU))
    model.spread = np.log10(spread)
    return model


def train(docs: DataFrame, text_col: str = "text", frequent: int = FREQUENT, endings: int = ENDINGS, classes: int = CLASSES, hot: int = HOT) -> ClassModel:
    model = _clustered(docs, text_col, frequent, endings, classes, hot)
    return _fitted(model, _classified(docs.select(F.lit(0).alias("id"), F.col(text_col).cast("string").alias("body"), F.lit(True).alias("training")), model))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The end token and at most ``most`` words: all above the least count that leaves no more than that.

    The least count is found in a histogram of a few thousand classes of counts, 1 % apart."""
    step = F.floor(F.log("n") * 100).cast("int")
    above, least = 0, 2**31 - 1
    for r in sorted(counts.where("n > 0").groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):
        above += r["count"]
        if above > most:
            break
        least = r.step
    return counts.where((F.col("word") == END) & (F.col("n") > 0) | (F.col("n") > 0) & (step >= least))


def _classified(picked: DataFrame, model: ClassModel) -> DataFrame:
    """(id, training, n_tokens, known, logs, classes), written once, of each row of (id, body, training).

    ``classes`` holds a byte a token, the end's too; ``logs`` sums the tokens' log10(n + alpha)."""
    bound_batches(picked)
    shared = picked.sparkSession.sparkContext.broadcast((model.hot, model.of[len(model.frequent) : -1]))
    names = ["id", "training", "row", "n_tokens", "known", "logs", "classes", "rare", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, class_of_ending = shared.value
        known = Known(hot[:, 0], np.arange(len(hot)))
        logs, seen, class_of = np.log10(hot[:, 1] + ALPHA), (hot[:, 1] > 0).astype(np.int64), hot[:, 2]
        row = TaskContext.get().partitionId() << 40
        for b in sliced(batches):
            sizes, line, tails = coded(utf8(b.column(1)))
            number, hit = known.find(line)
            start = np.cumsum(sizes) - sizes
            classes = np.where(hit, class_of[number], class_of_ending[ending(tails, len(class_of_ending))])
            at = np.flatnonzero(~hit)
            text = np.repeat(np.arange(len(sizes)), sizes)[at]
            order = np.lexsort((line[at], text))  # stable: places of a word ascend
            at, text, words = at[order], text[order], line[at][order]
            head = np.union1d(_runs(text), _runs(words))
            edge = pa.array(np.concatenate(([0], np.cumsum(np.bincount(text[head], minlength=len(sizes))))).astype(np.int32))
            places = _binaries((at - start[text]).astype("<u4").tobytes(), 4 * np.diff(np.append(head, len(at))))
            sums = [np.add.reduceat(np.where(hit, x[number], 0), start) for x in (seen, logs)]
            columns = [b.column(0), b.column(2), pa.array(row + np.arange(len(sizes))), pa.array(sizes.astype(np.int64)), *map(pa.array, sums), _binaries(classes.astype(np.uint8).tobytes(), sizes)]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(edge, pa.array(words[head])), pa.ListArray.from_arrays(edge, places)], names=names)
            row += len(sizes)

    schema = f"id {kind_of(picked, 'id')}, training boolean, row long, n_tokens long, known long, logs double, classes binary, rare array<long>, places array<binary>"
    parts = materialise(picked.mapInArrow(run, schema), "looked-up")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "places")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.places").alias("places"))
    joined = rare.join(model.counts, "word", "left").select("row", "places", "class", F.coalesce("n", F.lit(0)).alias("n"), (F.octet_length("places") / 4).cast("long").alias("times"))
    sums = joined.groupBy(F.col("row").alias("r")).agg(
        F.sum(F.col("times") * F.log10(F.col("n") + ALPHA)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_more"),
        F.collect_list(F.when(F.col("class").isNotNull(), F.struct("class", "places"))).alias("fixes"),
    )
    whole = parts.drop("rare", "places").join(sums, F.col("row") == F.col("r"), "left")
    whole = whole.select("id", "training", "n_tokens", (F.col("known") + F.coalesce("known_more", F.lit(0))).cast("long").alias("known"), (F.col("logs") + F.coalesce("more", F.lit(0.0))).alias("logs"), "classes", F.col("fixes.class").alias("fixed"), F.col("fixes.places").alias("places"))

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for given, classes, places in zip(*(b.column(i).to_pylist() for i in (5, 6, 7)), strict=True):
                if classes:
                    own = np.frombuffer(given, np.uint8).copy()
                    own[np.frombuffer(b"".join(places), "<u4")] = np.repeat(classes, [len(p) // 4 for p in places])
                    given = own.tobytes()
                out.append(given)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(out, pa.binary())], names=["id", "training", "n_tokens", "known", "logs", "classes"])

    return materialise(whole.mapInArrow(fix, f"id {kind_of(picked, 'id')}, training boolean, n_tokens long, known long, logs double, classes binary"), "classified")


def _class_pairs(classified: DataFrame, every: int) -> np.ndarray:
    """Counts of (class, next class) over all texts, each between two end tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(every * every, np.int64)
        for b in batches:
            line = _bytes_of(b.column(0))[0].astype(np.int64)
            total += np.bincount(_before(line, every - 1) * every + line, minlength=every * every) if len(line) else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    out = np.zeros(every * every)
    for r in classified.select("classes").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most the square of the classes
        out[r.cell] = r.n
    return out.reshape(every, every)


def _scored(classified: DataFrame, model: ClassModel, id_col: str) -> DataFrame:
    shared = classified.sparkSession.sparkContext.broadcast((model.transition, model.spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition, spread = shared.value
        for b in batches:
            line, sizes = _bytes_of(b.column(4))
            cost = transition[_before(line, len(spread) - 1), line] - spread[line]
            fixed = np.add.reduceat(cost, np.cumsum(sizes) - sizes) if len(sizes) else cost
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(fixed, pa.float64())], names=["id", "n_tokens", "known", "logs", "fixed"])

    whole = classified.drop("training").mapInArrow(run, f"id {kind_of(classified, 'id')}, n_tokens long, known long, logs double, fixed double")
    divisor = math.log10(model.n + ALPHA * (model.distinct + 1))
    scored = F.col("logs") + F.col("fixed")
    return whole.select(
        F.col("id").alias(id_col),
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * divisor).alias("base_score"),
        scored.alias("score"),
        F.pow(F.lit(10.0), -scored / F.col("n_tokens")).alias("perplexity"),
    )


def score(docs: DataFrame, model: ClassModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each row.

    ``base_score`` is the additive unigram model's log10 probability, ``score`` the class model's."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"), F.lit(False).alias("training"))
    return _scored(_classified(picked, model), model, id_col)


def train_and_score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, endings: int = ENDINGS, classes: int = CLASSES, hot: int = HOT) -> DataFrame:
    """What ``score`` gives for all ``docs`` with the model that ``train`` makes of those that aren't ``held``; words are looked up once for both."""
    kept = F.coalesce(held, F.lit(False))
    model = _clustered(docs.where(~kept), text_col, frequent, endings, classes, hot)
    found = _classified(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"), (~kept).alias("training")), model)
    return _scored(found, _fitted(model, found.where("training")), id_col)
