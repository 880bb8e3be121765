"""Language-model scoring with Brown classes: p(word | before) = p(class | class before) p(word | class).

Exchange clustering assigns every word of the training texts to a class. A round is one
distributed exchange: for every word its left and right neighbours are counted by class,
over all texts; then each word moves to the class under which these neighbours are
likeliest, all words at once against the counts of the round before. The first round
starts from classes by word endings.

Texts are coded once into blocks (the distinct words of about half a million tokens,
and each token's place among them) in a table bucketed by block. What travels after
that is, for a block, a number or two for each distinct word: counts to the words'
buckets, classes back. So the vocabulary may be of any size: no task and not the driver
holds more of it than one bucket's share. The driver holds a class-by-class matrix.

Smoothing: a word's share of its class gets 0.1 added, one unseen word for each class;
transitions are mixed with the share of the class. Probabilities sum to one over all
known words, the unseen word and the end.

Words are known by 64-bit hashes.

Defined cases: a null or empty text is just the end; null ids are held out; if nothing
teaches, every word is unseen; repeated rows are rows and count as often as they occur;
an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import fold, planes, shared_folder, slices, staged, table, unnamed, unplanes
from cashweave.llm.tokens import mix, spans, word_hashes

CLASSES = 16
ROUNDS = 2
BLOCK_TOKENS = 1 << 19
BUCKET_BYTES = 1 << 24
ADDED = 0.1
TRANSITION_PRIOR = 20.0
UNKNOWN = 255
_EDGE = CLASSES  # the class of starts and ends
_WIDTH = CLASSES + 1
_BLOCK = "block long, docs binary, lengths binary, train binary, tokens binary, words binary, endings binary, counts binary"
_COUNTED = "bucket int, block long, words binary, counts binary, right_n binary, right_c binary, right_k binary, left_n binary, left_c binary, left_k binary"
_ANSWER = "block long, bucket int, classes binary, counts binary"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts; columns doc_id, train (boolean), text."""
    part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def block():
        docs, lengths, train, hashes, endings = (np.concatenate(c) for c in zip(*held, strict=True))
        words, first, tokens = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.bincount(tokens[np.repeat(train, lengths)], minlength=len(words))
        cells = [docs.tobytes(), planes(lengths, 4), train.tobytes(), planes(tokens, 3), words.tobytes(), endings[first].tobytes(), planes(counts, 4)]
        return pa.RecordBatch.from_arrays([pa.array([(part << 32) + number], pa.int64()), *(pa.array([c], pa.binary()) for c in cells)], names=names)

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, data, at in slices(batch.column(2)):
            starts, ends, first = spans(data, at)
            last = data[ends - 1].astype(np.uint64)
            before = np.where(ends - 2 >= starts, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
            for b in (last, before):
                b[(b >= 0x41) & (b <= 0x5A)] += np.uint64(32)
            endings = (mix(last * np.uint64(256) + before) % np.uint64(CLASSES)).astype(np.uint8)
            held.append((ids[lo:hi], np.diff(first), train[lo:hi], word_hashes(data, starts, ends, lower=True), endings))
            size += len(starts)
            if size >= BLOCK_TOKENS:
                yield block()
                number, held, size = number + 1, [], 0
    if held:
        yield block()


def code(docs: DataFrame, train: Column) -> DataFrame:
    """The blocks, as a table bucketed by block. train: condition on doc_id."""
    spark = docs.sparkSession
    source = unnamed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    # A null id is coded as the least long, which is never given out again.
    filled = source.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    name = f"cashweave_blocks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = filled.mapInArrow(_coded, _BLOCK).write.option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}").bucketBy(parts, "block")
    writer.saveAsTable(name)
    return spark.table(name)


class _Block:
    """One row of the coded table, with classes and counts of its words if they are known."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.docs = np.frombuffer(row["docs"], np.int64)
        self.lengths = unplanes(row["lengths"], 4).astype(np.int64)
        self.train = np.frombuffer(row["train"], bool)
        self.tokens = unplanes(row["tokens"], 3).astype(np.int64)
        if row.get("answers") is not None:
            answers = sorted(row["answers"], key=lambda a: a["bucket"])
            self.classes = np.frombuffer(b"".join(a["classes"] for a in answers), np.uint8)
            self.known = np.concatenate([unplanes(a["counts"], 6) for a in answers]).astype(np.int64) if answers else np.zeros(0, np.int64)
        else:
            self.classes, self.known = np.frombuffer(row["endings"], np.uint8), None

    def sequence(self, only_train: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, class before each, class after each); starts and ends are _EDGE."""
        lengths = self.lengths[self.train] if only_train else self.lengths
        tokens = self.tokens[np.repeat(self.train, self.lengths)] if only_train else self.tokens
        own = self.classes[tokens].astype(np.int64)
        before, after = np.empty_like(own), np.empty_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        ends = np.cumsum(lengths)[lengths > 0]
        before[ends - lengths[lengths > 0]] = _EDGE
        after[ends - 1] = _EDGE
        return tokens, before, after


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block(batch.slice(i, 1).to_pylist()[0])


def _matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training transitions between classes, summed in the task."""
    total = np.zeros(_WIDTH * _WIDTH, np.int64)
    for b in _blocks(batches):
        tokens, before, after = b.sequence(only_train=True)
        own = b.classes[tokens].astype(np.int64)
        total += np.bincount(before * _WIDTH + own, minlength=len(total))
        ends = after == _EDGE
        total += np.bincount(own[ends] * _WIDTH + _EDGE, minlength=len(total))
        total[_EDGE * _WIDTH + _EDGE] += int((b.lengths[b.train] == 0).sum())
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], names=["cell", "n"])


def transitions(blocks: DataFrame) -> np.ndarray:
    """CLASSES + 1 by CLASSES + 1 counts; the last row and column are starts and ends."""
    out = np.zeros(_WIDTH * _WIDTH)
    for row in blocks.mapInArrow(_matrix, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out.reshape(_WIDTH, _WIDTH)


def _counts_by_bucket(bits: int):
    """For each bucket of words: their counts, and their neighbours' counts by class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _COUNTED.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                b, words, counts = _Block(row), np.frombuffer(row["words"], np.uint64), unplanes(row["counts"], 4)
                tokens, before, after = b.sequence(only_train=True)
                sides = []
                for near in (after, before):
                    grid = np.bincount(tokens * _WIDTH + near, minlength=len(words) * _WIDTH).reshape(len(words), _WIDTH)
                    sides.append((grid, (grid > 0).sum(axis=1)))
                edges = np.searchsorted(words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(words)]
                out: list[list] = [[] for _ in names]
                for bucket in range(1 << bits):
                    lo, hi = edges[bucket], edges[bucket + 1]
                    if lo == hi:
                        continue
                    cells = [bucket, b.block, words[lo:hi].tobytes(), planes(counts[lo:hi], 4)]
                    for grid, kinds in sides:
                        part = grid[lo:hi]
                        where = np.nonzero(part)
                        cells += [kinds[lo:hi].astype(np.uint8).tobytes(), where[1].astype(np.uint8).tobytes(), planes(part[where], 4)]
                    for column, cell in zip(out, cells, strict=True):
                        column.append(cell)
                types = [pa.int32(), pa.int64(), *[pa.binary()] * 8]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return count


def _exchange(matrix: np.ndarray):
    """All words of one bucket choose their classes anew, and every block gets its words' answers."""
    right = np.log((matrix[:CLASSES] + 0.5) / (matrix[:CLASSES] + 0.5).sum(axis=1, keepdims=True))
    left = np.log((matrix.T[:CLASSES] + 0.5) / (matrix.T[:CLASSES] + 0.5).sum(axis=1, keepdims=True))

    def choose(key: tuple, rows: pa.Table) -> pa.Table:
        columns = {c: rows.column(c).to_pylist() for c in rows.column_names}
        each = [np.frombuffer(w, np.uint64) for w in columns["words"]]
        words, place = np.unique(np.concatenate(each), return_inverse=True)
        counts = np.bincount(place, np.concatenate([unplanes(c, 4) for c in columns["counts"]]), minlength=len(words)).astype(np.int64)
        worth = np.zeros((len(words), CLASSES))
        for side, logs in (("right", right), ("left", left)):
            kinds = np.frombuffer(b"".join(columns[f"{side}_n"]), np.uint8)
            near = np.frombuffer(b"".join(columns[f"{side}_c"]), np.uint8).astype(np.int64)
            times = np.concatenate([unplanes(k, 4) for k in columns[f"{side}_k"]])
            vectors = np.bincount(np.repeat(place, kinds) * _WIDTH + near, times, minlength=len(words) * _WIDTH).reshape(-1, _WIDTH)
            worth += vectors @ logs.T
        classes = worth.argmax(axis=1).astype(np.uint8)
        classes[counts == 0] = UNKNOWN
        at = np.cumsum([0, *map(len, each)])
        own = [place[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        seen = classes != UNKNOWN
        totals = np.stack([np.bincount(classes[seen], counts[seen], minlength=CLASSES), np.bincount(classes[seen], minlength=CLASSES)]).astype("<i8")
        return pa.table(
            [
                pa.array([*columns["block"], -1], pa.int64()),
                pa.array([key[0].as_py()] * (len(own) + 1), pa.int32()),
                pa.array([*(classes[o].tobytes() for o in own), totals.tobytes()], pa.binary()),
                pa.array([*(planes(counts[o], 6) for o in own), b""], pa.binary()),
            ],
            names=["block", "bucket", "classes", "counts"],
        )

    return choose


def _answered(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_block = answers.where("block >= 0").repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("bucket", "classes", "counts")).alias("answers"))
    return blocks.join(by_block, "block", "left").withColumn("answers", F.coalesce("answers", F.array().cast("array<struct<bucket:int,classes:binary,counts:binary>>")))


def cluster(blocks: DataFrame, rounds: int = ROUNDS, bits: int = 6) -> tuple[DataFrame, DataFrame]:
    """The blocks with their words' classes and training counts (column answers); the answers by bucket."""
    current = blocks
    for _ in range(rounds):
        matrix = transitions(current)
        counted = current.mapInArrow(_counts_by_bucket(bits), _COUNTED)
        answers = staged(counted.groupBy("bucket").applyInArrow(_exchange(matrix), _ANSWER), "classes")
        current = _answered(blocks, answers)
    return current, answers


def _sums(values: np.ndarray, begins: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Sums over texts; each is added up by itself, so that long blocks cost no digits."""
    out = np.zeros(len(full), values.dtype)
    if full.any():
        out[full] = np.add.reduceat(values, begins[full])
    return out


def _scorer(matrix: np.ndarray, tokens_in: np.ndarray, types_in: np.ndarray):
    """Scores of all texts of blocks. tokens_in, types_in: by class, the end being a class of its own."""
    total = tokens_in.sum()
    share = tokens_in / max(total, 1)
    before = np.vstack([matrix, matrix.sum(axis=0, keepdims=True)])  # last: after an unseen word
    step = (before + TRANSITION_PRIOR * share) / (before.sum(axis=1, keepdims=True) + TRANSITION_PRIOR) if total else np.full((_WIDTH + 1, _WIDTH), 1 / _WIDTH)
    room = tokens_in + ADDED * (types_in + 1)
    room[_EDGE] = 1.0  # the end is all of its class
    unseen = np.append(ADDED / room[:CLASSES], 0.0)
    log_step, log_room = np.log10(np.maximum(step, 1e-300)), np.log10(room)
    log_unseen = np.log10(step @ unseen)
    vocabulary = types_in[:CLASSES].sum() + (tokens_in[_EDGE] > 0)
    base_room = total + ADDED * (vocabulary + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            tokens, prior, after = b.sequence(only_train=False)
            own, counts = b.classes[tokens].astype(np.int64), b.known[tokens]
            prior = np.where(prior == UNKNOWN, _WIDTH, prior)
            seen = own != UNKNOWN
            word = np.where(seen, own, 0)
            logs = np.where(seen, log_step[prior, word] + np.log10(counts + ADDED) - log_room[word], log_unseen[prior])
            plain = np.log10(counts + ADDED)
            edges = np.concatenate([[0], np.cumsum(b.lengths)])
            full = b.lengths > 0
            s, p, known = (_sums(v, edges[:-1], full) for v in (logs, plain, (counts > 0).astype(np.int64)))
            last = np.full(len(b.lengths), _EDGE)
            last[full] = np.where(own[edges[1:][full] - 1] == UNKNOWN, _WIDTH, own[edges[1:][full] - 1])
            n = b.lengths + 1
            ends = tokens_in[_EDGE]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(b.docs, mask=b.docs == -(1 << 63)),
                    pa.array(n),
                    pa.array((known + (ends > 0)).astype(np.int64)),
                    pa.array(np.full(len(n), int(total))),
                    pa.array(p + np.log10(ends + ADDED) - n * np.log10(base_room)),
                    pa.array(s + log_step[last, _EDGE]),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return score


def class_scores(docs: DataFrame, train: Column, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row.

    train: a condition on doc_id; only texts for which it holds teach.
    """
    size = unnamed(docs, "text").agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = code(docs, train)
    bits = max(6, (size // BUCKET_BYTES).bit_length())
    classed, answers = cluster(blocks, rounds, bits)
    totals = np.zeros((2, CLASSES))
    packed = answers.where("block = -1").select("classes").mapInArrow(_totals, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for row in packed.collect():
        totals.reshape(-1)[row["cell"]] = row["n"]
    matrix = transitions(classed)
    ends = matrix[:, _EDGE].sum()
    tokens_in, types_in = np.append(totals[0], ends), np.append(totals[1], 1.0 if ends else 0.0)
    scored = classed.mapInArrow(_scorer(matrix, tokens_in, types_in), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * CLASSES, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            total += np.frombuffer(raw, "<i8")
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["cell", "n"])


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = class_scores(table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return done.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
