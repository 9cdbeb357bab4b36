"""LM scoring: a hashed maximum-entropy model with class-factored softmax, and exact unigram scores.

P(word | history) = P(class | history) * P(word | class, history), with classes of classes where the vocabulary
is large (:class:`Tree`).  Each softmax is log-linear in hashed features of the history: the last word, the last
two words, and the last but one (a skip).  Words below a count floor are one class whose words share its mass by
smoothed counts.

Texts are turned into word numbers once.  Training then deals them to workers by a hash of the row; the number of
workers follows the corpus, not the cluster.  In each of ``ROUNDS`` rounds every worker makes gradient steps from the
common weights, and each row of weights becomes the mean over the workers that used it, weighted by use.  The
vocabulary, the table of weights and a worker's share all grow with the square root of the training tokens, so what
the workers send grows in proportion to the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, flat_words, gathered, slices, stored

#: Outcomes of a softmax.
WIDTH = 32
#: Root classes that hold words, that hold classes of words, and that hold deeper classes; one more is for all rare words.
NEAR, MIDDLE, DEEP = 16, 8, 7
#: Features of the softmaxes from the root down: 0 the last word, 1 the last two words, 2 the last but one.  The deepest
#: have none: words that share their class of WIDTH rare enough words have their shares of it.
FEATURES = ((0, 1, 2), (0, 2), (0,), ())
#: Words modelled one by one, rows of hashed weights, and a worker's tokens a round, for each square root of the training tokens.
WORDS_PER_ROOT = 24
ROWS_PER_ROOT = 28
SHARE_PER_ROOT = 434
LEAST_BITS = 10
#: Words whose pairs are features.
PAIRED = NEAR * WIDTH
ROUNDS = 2
RATE = 0.3
#: Tokens whose gradients are taken together.
BATCH = 4096
#: Longer words are known by a digest of 128 bits, so that no key is long.
LONGEST = 64
#: Texts that are split into words together, and their bytes (but one text at least).
ROWS = 2048
TEXT_BYTES = 4 << 20
#: The end of a text as a word: no word holds white space.
END = b" "
#: Rows of weights that travel together.
BLOCK = 128


def keys(words: pa.Array) -> pa.Array:
    """Words as bytes; in place of a long one white space (which no word holds) and its digest."""
    long = np.flatnonzero(pc.greater(pc.binary_length(words), LONGEST).to_numpy(zero_copy_only=False))
    plain = words.cast(pa.binary())
    if not len(long):
        return plain
    out = plain.to_pylist()
    for i in long:
        out[i] = b" " + xxhash.xxh3_128_hexdigest(out[i]).encode()
    return pa.array(out, pa.binary())


def word_counts(docs: DataFrame, text_col: str, training: Column) -> DataFrame:
    """(word, n) over all training rows, the end counted once a row; counted in slices of texts before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROWS, TEXT_BYTES):
            found = flat_words(part.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays([keys(found.field("values")), found.field("counts")], names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([part.num_rows], pa.int64())], names=["word", "n"])

    found = docs.where(training).select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """The words modelled one by one, most frequent first, with their counts, and the totals."""

    words: list[bytes]
    n: np.ndarray
    tokens: int
    distinct: int

    @property
    def whole(self) -> int:
        """Denominator of a word's smoothed share of all tokens."""
        return self.tokens + self.distinct + 1

    @property
    def rare(self) -> int:
        """Denominator of a word's smoothed share of the class of all rare words."""
        return self.whole - int(self.n.sum()) - len(self.n)


def frequent(table: DataFrame, per_root: float = WORDS_PER_ROOT) -> Counts:
    """The words of at least the lowest count that ``per_root`` words for each root of the tokens allow.

    A histogram over at most 256 + 32 * 40 steps of the count gives that floor, so no task sorts the words.
    """
    total = table.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = int(total[0] or 0), int(total[1])
    most = max(64, int(per_root * tokens**0.5))
    step = F.when(F.col("n") < 256, F.col("n")).otherwise(256 + F.floor(32 * F.log2(F.col("n") / 256.0)))
    floor, words = None, 0
    for r in sorted(table.groupBy(step.alias("step")).agg(F.min("n").alias("least"), F.count("*").alias("words")).collect(), reverse=True):
        words += r.words
        if words > most:
            break
        floor = r.least
    if floor is None:
        return Counts([], np.zeros(0, np.int64), tokens, distinct)
    top = table.where(F.col("n") >= floor).toArrow()
    n, known = top.column("n").to_numpy(), top.column("word").to_pylist()
    order = sorted(range(len(n)), key=lambda i: (-n[i], known[i]))
    return Counts([known[i] for i in order], n[order], tokens, distinct)


class Tree:
    """Classes of words by frequency: the path of each rank from the root softmax to its word.

    The NEAR * WIDTH most frequent words are children of a root class, the next MIDDLE * WIDTH ** 2 lie one
    softmax deeper, all others ``depth`` softmaxes below the root; rank ``n_words`` is the class of rare words.
    """

    def __init__(self, n_words: int):
        self.n_words = n_words
        first, second = NEAR * WIDTH, NEAR * WIDTH + MIDDLE * WIDTH**2
        self.depth = 3
        while DEEP * WIDTH**self.depth < n_words - second:
            self.depth += 1
        #: (first rank, end, first root class, levels below the root, first node of each level)
        self.bands = []
        nodes = 1
        for start, end, child, levels in ((0, first, 0, 1), (first, second, NEAR, 2), (second, max(second, n_words), NEAR + MIDDLE, self.depth)):
            used = max(0, min(end, n_words) - start)
            begin = []
            for level in range(1, levels + 1):
                begin.append(nodes)
                nodes += -(-used // WIDTH ** (levels - level + 1))
            self.bands.append((start, end, child, levels, begin))
        self.nodes = nodes

    def steps(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each level: (places in ``ids``, node, child) of the softmaxes on the paths, from the root down."""
        child = np.full(len(ids), WIDTH - 1)
        parts = []
        for start, end, first, levels, begin in self.bands:
            at = np.flatnonzero((ids >= start) & (ids < min(end, self.n_words)))
            q = ids[at] - start
            child[at] = first + q // WIDTH**levels
            parts.append((at, q, levels, begin))
        yield np.arange(len(ids)), np.zeros(len(ids), np.int64), child
        for level in range(1, self.depth + 1):
            found = [(at, begin[level - 1] + q // WIDTH ** (levels - level + 1), q // WIDTH ** (levels - level) % WIDTH) for at, q, levels, begin in parts if level <= levels and len(at)]
            if found:
                yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


_ONES = np.ones((WIDTH, 1), np.float32)


class Model:
    """Weights: one row of WIDTH for each hashed (feature, node), then one bias row for each node; use of each row."""

    def __init__(self, tree: Tree, bits: int, table: np.ndarray | None = None, seen: np.ndarray | None = None):
        self.tree, self.bits = tree, bits
        size = (1 << bits) + tree.nodes
        self.table = np.zeros((size, WIDTH), np.float32) if table is None else table
        self.seen = np.ones(size, np.float32) if seen is None else seen

    @staticmethod
    def start(counts: Counts, bits: int) -> Model:
        """Biases that give each class and word its share of the training tokens; all other weights 0."""
        m = Model(Tree(len(counts.n)), bits)
        mass = np.full(m.tree.nodes * WIDTH, 1e-6)
        ranks = np.arange(len(counts.n) + 1)
        n = np.append(counts.n + 0.5, counts.tokens - counts.n.sum() + 1.0)
        for at, node, child in m.tree.steps(ranks):
            mass += np.bincount(node * WIDTH + child, n[at], len(mass))
        mass = mass.reshape(-1, WIDTH)
        m.table[1 << bits :] = np.log(mass / mass.sum(1, keepdims=True))
        return m

    def rows(self, codes: np.ndarray, at: np.ndarray, node: np.ndarray, level: int) -> list[np.ndarray]:
        """Rows of weights that a softmax adds up: three features (two below the first class), and the bias."""
        salt = (node.astype(np.uint32) + np.uint32(11)) * np.uint32(668265263)
        used = FEATURES[min(level, len(FEATURES) - 1)]
        return [*(((codes[k][at] ^ salt) * np.uint32(3266489917) >> np.uint32(32 - self.bits)).astype(np.int64) for k in used), (1 << self.bits) + node]

    def powers(self, rows: list[np.ndarray]) -> np.ndarray:
        """exp of the sums of rows (sums above 60 count as 60, so that no power overflows)."""
        z = self.table.take(rows[0], axis=0)
        for r in rows[1:]:
            z += self.table.take(r, axis=0)
        np.minimum(z, 60, out=z)
        return np.exp(z, out=z)

    def learn(self, codes: np.ndarray, ids: np.ndarray) -> None:
        """One gradient step for the tokens ``ids`` (step sizes by Adagrad, one for each row)."""
        for level, (at, node, child) in enumerate(self.tree.steps(ids)):
            rows = self.rows(codes, at, node, level)
            if len(rows) == 1:
                break  # the deepest softmaxes stay at their words' shares
            p = self.powers(rows)
            p /= p @ _ONES
            p[np.arange(len(at)), child] -= 1
            if level < 2:
                # Few nodes: their biases' gradients are one small product.
                nodes, place = np.unique(node, return_inverse=True)
                rows.pop()
                self._move(nodes + (1 << self.bits), p.T @ (place[:, None] == np.arange(len(nodes))).astype(np.float32))
            packed = np.concatenate([r << 32 | np.arange(len(at)) for r in rows])
            packed.sort()
            keys = packed >> 32
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            # Sums of each row's run; one outcome after the other, as its gradients fit the cache.
            total = np.add.reduceat(np.ascontiguousarray(p.T).take(packed & 0xFFFFFFFF, axis=1), first, axis=1)
            self._move(keys[first], total)

    def _move(self, at: np.ndarray, total: np.ndarray) -> None:
        """Step against the gradients ``total``, one column for each row ``at`` of weights."""
        self.seen[at] += np.einsum("ij,ij->j", total, total)
        total *= RATE / np.sqrt(self.seen[at])
        self.table[at] -= total.T

    def log10(self, codes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 P of each token given its history (of the class alone for rare words)."""
        out = np.zeros(len(ids))
        for begin in range(0, len(ids), BATCH):
            s = slice(begin, begin + BATCH)
            part = np.zeros(len(ids[s]))
            for level, (at, node, child) in enumerate(self.tree.steps(ids[s])):
                z = self.powers(self.rows(codes[:, s], at, node, level))
                part[at] += np.log(z[np.arange(len(at)), child] / (z @ _ONES)[:, 0])
            out[s] = part / np.log(10)
        return out


def histories(ids: np.ndarray, starts: np.ndarray, unknown: int) -> np.ndarray:
    """Feature codes (3, n) of token ids; ``starts`` are the places where texts begin.

    Pairs of words that are not both among the PAIRED most frequent share one code: they hardly come again.
    """
    one = np.empty(len(ids), np.uint32)
    two = np.empty(len(ids), np.uint32)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    begin = np.uint32(unknown + 1)
    one[starts] = begin
    two[starts] = begin
    later = starts + 1
    two[later[later < len(ids)]] = begin
    a, b = np.uint32(2654435761), np.uint32(2246822519)
    both = ((one + np.uint32(1)) * a ^ (two + np.uint32(3)) * b) * a
    skip = (two + np.uint32(7)) * b ^ np.uint32(0x5BD1E995)
    return np.stack([(one + np.uint32(1)) * a, np.where(np.maximum(one, two) < PAIRED, both, np.uint32(0)), skip])


def encode(docs: DataFrame, counts: Counts, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    """(row, id, held_out, n_tokens, n_known, base, ids, rare) for every row of ``docs``, written once.

    ``ids``: ranks of all tokens as 32-bit integers, rare words with the rank behind the last.  ``rare``: their keys
    and how often the text holds them.  ``n_known`` and ``base`` are those of the other words.
    """
    blob, n_words, log_n = b"\n".join(counts.words), len(counts.words), np.append(np.log10((counts.n + 1.0) / counts.whole), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(blob.split(b"\n") if n_words else [], pa.binary())
        end = pc.index_in(pa.scalar(END, pa.binary()), value_set=known).as_py()
        end = n_words if end is None else end

        def rows() -> Iterator[pa.RecordBatch]:
            for part in slices(batches, ROWS, TEXT_BYTES):
                flat, lengths = flat_words(part.column(3))
                coded = flat.dictionary_encode()
                names = keys(coded.dictionary)
                word = coded.indices.to_numpy()
                n_docs, owner = len(lengths), np.repeat(np.arange(len(lengths)), lengths)
                ranks = pc.index_in(names, value_set=known).fill_null(n_words).to_numpy()[word]
                ids = np.empty(len(word) + n_docs, np.int32)
                stops = np.cumsum(lengths + 1)
                inside = np.ones(len(ids), bool)
                inside[stops - 1] = False
                ids[inside], ids[stops - 1] = ranks, end
                owner = np.concatenate([owner, np.arange(n_docs)])
                every = np.concatenate([ranks, np.full(n_docs, end, ranks.dtype)])
                other = np.flatnonzero(every == n_words)
                # Rare words of each text, once each; the end is rare where no training text has one.
                which = np.concatenate([word, np.full(n_docs, len(names), word.dtype)])[other]
                pairs, times = np.unique(owner[other] * (len(names) + 1) + which, return_counts=True)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(pairs // (len(names) + 1), minlength=n_docs))])
                own = pa.concat_arrays([names, pa.array([END], pa.binary())]).take(pa.array(pairs % (len(names) + 1)))
                items = pa.StructArray.from_arrays([own, pa.array(times, pa.int64())], names=["word", "times"])
                cuts = np.concatenate([[0], stops])
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3], pa.array(lengths + 1), pa.array(np.bincount(owner, every < n_words, n_docs).astype(np.int64)), pa.array(np.bincount(owner, log_n[every], n_docs)),
                        pa.array([ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
                    ],
                    names=["row", "id", "held_out", "n_tokens", "n_known", "base", "ids", "rare"],
                )

        yield from gathered(rows(), 1024)

    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    schema = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, ids binary, rare array<struct<word:binary,times:long>>"
    return stored(narrow.mapInArrow(run, schema), "encoded")


def flat_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of several texts, and where each text starts."""
    lengths = np.array([len(t) // 4 for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.int32).astype(np.int64), np.cumsum(lengths) - lengths


def train(encoded: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """Weights after one pass over all training rows of :func:`encode`, in ``rounds`` rounds.

    A row goes to a round and a worker by a hash of its number, so no worker is larger than others by more than a
    text, and a worker reads its rows in the same order whatever the partitions are.
    """
    root = max(1.0, float(counts.tokens)) ** 0.5
    bits = max(LEAST_BITS, round(np.log2(ROWS_PER_ROOT * root)))
    model = Model.start(counts, bits)
    if not counts.tokens:
        return model
    n_words = len(counts.n)
    workers = max(1, round(root / SHARE_PER_ROOT / rounds))
    h = F.xxhash64("row", F.lit(9))
    dealt = encoded.where("not held_out").select(F.pmod(h, F.lit(rounds)).alias("round"), F.pmod(F.shiftrightunsigned(h, 20), F.lit(workers)).alias("worker"), "row", "ids")
    for k in range(rounds):
        table, seen = model.table.astype(np.float16), model.seen

        def run(batches: Iterator[pa.RecordBatch], table=table, seen=seen) -> Iterator[pa.RecordBatch]:
            at, own, uses = None, None, None
            buffer: list[bytes] = []

            def learn() -> None:
                ids, starts = flat_ids(buffer)
                codes = histories(ids, starts, n_words)
                for begin in range(0, len(ids), BATCH):
                    own.learn(codes[:, begin : begin + BATCH], ids[begin : begin + BATCH])
                buffer.clear()

            def moves() -> Iterator[pa.RecordBatch]:
                if buffer:
                    learn()
                used = own.seen - seen
                for begin in range(0, len(used), BLOCK * 64):
                    blocks = [b for b in range(begin, min(len(used), begin + BLOCK * 64), BLOCK) if used[b : b + BLOCK].any()]
                    change = [(own.table[b : b + BLOCK] - table[b : b + BLOCK]).astype(np.float16).tobytes() for b in blocks]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b // BLOCK for b in blocks], pa.int64()), pa.array([used[b : b + BLOCK].tobytes() for b in blocks], pa.binary()), pa.array(change, pa.binary())],
                        names=["block", "used", "change"],
                    )

            for batch in batches:
                for part in slices(iter([batch]), 4096):
                    for worker, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        if worker != at:
                            if own is not None:
                                yield from moves()
                            at, own, uses = worker, Model(Tree(n_words), bits, table.astype(np.float32), seen.copy()), 0
                        buffer.append(ids)
                        uses += len(ids) // 4
                        if uses >= 4 * BATCH:
                            learn()
                            uses = 0
            if own is not None:
                yield from moves()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for part in slices(iter([batch])):
                    for block, used, change in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                        u = np.frombuffer(used, np.float32)
                        own = sums.setdefault(block, [np.zeros(len(u)), np.zeros(len(u)), np.zeros((len(u), WIDTH))])
                        own[0] += u
                        own[1] += u * u
                        own[2] += u[:, None] * np.frombuffer(change, np.float16).reshape(-1, WIDTH)
            # Means over the workers, weighted by use: of the change, and of the use itself.
            safe = lambda u: np.where(u > 0, u, 1.0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.int64()), pa.array([(v / safe(u)).astype(np.float32).tobytes() for u, v, _ in sums.values()], pa.binary()),
                    pa.array([(c / safe(u)[:, None]).astype(np.float16).tobytes() for u, _, c in sums.values()], pa.binary()),
                ],
                names=["block", "used", "change"],
            )

        schema = "block long, used binary, change binary"
        given = dealt.where(F.col("round") == k).repartitionByRange(workers, "worker").sortWithinPartitions("worker", "row").select("worker", "ids")
        merged = given.mapInArrow(run, schema).repartition("block").mapInArrow(add, schema).toArrow()
        new, new_seen = table.astype(np.float32), seen.copy()
        for block, used, change in zip(merged.column("block").to_pylist(), merged.column("used"), merged.column("change"), strict=True):
            rows = slice(block * BLOCK, (block + 1) * BLOCK)
            new_seen[rows] += np.frombuffer(used.as_py(), np.float32)
            new[rows] += np.frombuffer(change.as_py(), np.float16).reshape(-1, WIDTH)
        model = Model(model.tree, bits, new, new_seen)
    return model


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Learns from the rows where ``held_out`` is false.  Null and empty texts hold the end alone.  Whole texts
    are read, long ones piece by piece.  ``base_score`` is exact over all training counts: those of the
    words modelled one by one go to every task, a text's other words are joined with their counts, once for
    each text.  Repeated rows each get their row (and teach each time); an empty table gives none; without
    training rows all words are new.  Columns other than the id, the text and those in ``held_out`` are not read.
    """
    out = F.coalesce(held_out, F.lit(False))
    table = stored(word_counts(docs, text_col, ~out), "counts")
    counts = frequent(table)
    encoded = encode(docs, counts, id_col, text_col, out)
    model = train(encoded, counts)
    n_words, bits, weights = len(counts.n), model.bits, model.table.astype(np.float16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(Tree(n_words), bits, weights.astype(np.float32))

        def rows() -> Iterator[pa.RecordBatch]:
            for part in slices(batches, 64):
                ids, starts = flat_ids(part.column(part.num_columns - 1).to_pylist())
                p = own.log10(histories(ids, starts, n_words), ids)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.add.reduceat(p, starts))], names=[*part.schema.names[:-1], "model"])

        yield from gathered(rows())

    schema = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, model double"
    scored = stored(encoded.select("row", "id", "held_out", "n_tokens", "n_known", "base", "ids").mapInArrow(run, schema), "scores")
    words = stored(encoded.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.times"), "rare")
    discard(encoded)
    new = F.coalesce("n", F.lit(0).cast("long"))
    share = lambda of: F.sum(F.col("times") * F.log10((new + 1.0) / of))
    met = words.join(table, "word", "left").groupBy("row").agg(F.sum(F.when(new > 0, F.col("times")).otherwise(0)).alias("more"), share(counts.whole).alias("own"), share(counts.rare).alias("within"))
    or_none = lambda c, zero: F.coalesce(c, F.lit(zero))
    return scored.join(met, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + or_none("more", 0)).cast("long").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + or_none("own", 0.0)).alias("base_score"),
        (F.col("model") + or_none("within", 0.0)).alias("score"),
    )
