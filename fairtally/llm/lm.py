"""Language-model scores from a weighted backoff automaton whose n-grams stay spread over the cluster.

States are the known contexts, arcs the known n-grams with smoothed probabilities; a state without an
arc for the next word fails to its shorter context at the price of a backoff weight. Each text carries
its state from word to word and adds up the weights on its way. No task ever
holds the whole automaton. Documents are read in chunks; each chunk asks once for the counts of its
own distinct n-grams (sorted hashes, a few bytes each) and so gets just the part of the automaton
that its texts can traverse. The same question carries the chunk's own training counts.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 3
#: Pseudo-count of the shorter context's distribution; by order of the n-gram.
PRIOR = 200.0
CHUNK_TOKENS = 2_000_000
BUCKET_KEYS = 3_000_000
CACHE_WORDS = 200_000
#: Tokens of a long text that are walked one after the other.
SEGMENT = 1024
#: Arcs that are weighed at a time.
ARCS = 1 << 18

START, END = 0x243F6A8885A308D3, 0x13198A2E03707344

ASKED = "bucket bigint, chunk bigint, level int, keys binary, counts binary"
ANSWERED = "chunk bigint, level int, bucket bigint, counts binary, tokens bigint, words bigint"
CONTENT = "chunk bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, vocabulary binary, tokens binary"
SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shrunk(values: np.ndarray) -> bytes:
    """An array as compressed byte planes: the high bytes of small numbers cost nothing."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def grown(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def shrunk_keys(keys: np.ndarray) -> bytes:
    return shrunk(np.diff(keys, prepend=np.uint64(0)))


def grown_keys(data: bytes) -> np.ndarray:
    return np.cumsum(grown(data, np.uint64), dtype=np.uint64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, ascending, the order that sorts all, and where a new key begins in that order."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first], order, first


def added(values: np.ndarray, order: np.ndarray, first: np.ndarray, kind: type) -> np.ndarray:
    """The sum of the values of each distinct key."""
    return np.add.reduceat(values[order], np.flatnonzero(first), dtype=kind) if len(order) else np.empty(0, kind)


def numbers(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The number of each key among the distinct ones."""
    found = np.empty(len(order), np.int32)
    found[order] = np.cumsum(first, dtype=np.int32) - np.int32(1)
    return found


@dataclass
class Chunk:
    """Whole documents one after the other: hashes of their words, each text closed by END."""

    number: int
    doc_ids: list
    held: list
    sizes: np.ndarray
    hashes: np.ndarray

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per level 1 to ``order``: the n-gram that ends at each token, and where it is one.

        A text starts behind START, which is part of contexts but never a token.
        """
        at = np.arange(len(self.hashes), dtype=np.int32) - np.repeat((np.cumsum(self.sizes) - self.sizes).astype(np.int32), self.sizes)
        key = mixed(self.hashes)
        yield key, np.ones(len(key), bool)
        for level in range(2, order + 1):
            before = np.empty_like(key)
            before[1:] = key[:-1]
            del key
            if level == 2:
                before[at == 0] = mixed(np.array([START], np.uint64))[0]
            before *= np.uint64(0x9E3779B97F4A7C15)
            before += self.hashes
            before += np.uint64(level)
            key = mixed(before)
            del before
            yield key, at >= level - 2


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Chunk]:
    """Chunks of about ``most`` tokens, in the order of the task's rows."""
    words, task, count = Words(), TaskContext.get().partitionId(), 0
    ids, held, sizes, hashes, total = [], [], [], array("Q"), 0

    def done() -> Chunk:
        return Chunk((task << 24) + count, ids, held, np.array(sizes, np.int64), np.frombuffer(hashes, np.uint64))

    for batch in batches:
        for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
            own = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
            ids.append(doc_id)
            held.append(out)
            sizes.append(len(own) + 1)
            hashes.extend(map(words.__getitem__, own))
            hashes.append(END)
            total += len(own) + 1
            if total >= most:
                yield done()
                ids, held, sizes, hashes, total, count = [], [], [], array("Q"), 0, count + 1
    if ids:
        yield done()


def _ask(order: int, buckets: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, most):
            train = np.repeat(~np.array(chunk.held, bool), chunk.sizes)
            for level, (key, valid) in enumerate(chunk.grams(order), 1):
                keys, sorting, first = runs(key[valid])
                del key
                counts = added(train[valid], sorting, first, np.uint32)
                del valid, sorting, first
                # Buckets are ranges of the hash, so a bucket's keys are neighbours.
                bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keys) else []
                rows = [
                    (int(bucket[a]), chunk.number, level, shrunk_keys(keys[a:b]), shrunk(counts[a:b])) for a, b in zip(edges, edges[1:])
                ]
                for start in range(0, len(rows), 512):
                    columns = list(zip(*rows[start : start + 512]))
                    yield pa.record_batch(
                        [
                            pa.array(columns[0], pa.int64()),
                            pa.array(columns[1], pa.int64()),
                            pa.array(columns[2], pa.int32()),
                            pa.array(columns[3], pa.binary()),
                            pa.array(columns[4], pa.binary()),
                        ],
                        names=["bucket", "chunk", "level", "keys", "counts"],
                    )

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Adds the counts of equal keys over all chunks, and gives each chunk the totals of its keys."""
    rows = asked.to_pylist()
    found = []
    for level in sorted({r["level"] for r in rows}):
        own = sorted((r for r in rows if r["level"] == level), key=lambda r: r["chunk"])
        parts = [grown_keys(r["keys"]) for r in own]
        edges = np.cumsum([0] + [len(k) for k in parts])
        keys = np.concatenate(parts)
        del parts
        _, sorting, first = runs(keys)
        del keys
        totals = added(np.concatenate([grown(r["counts"], np.uint32) for r in own]), sorting, first, np.uint64)
        at = numbers(sorting, first)
        del sorting, first
        for i, r in enumerate(own):
            # The size of the training text is told once per bucket, with the first chunk.
            told = level == 1 and i == 0
            found.append(
                {
                    "chunk": r["chunk"],
                    "level": level,
                    "bucket": r["bucket"],
                    "counts": shrunk(totals[at[edges[i] : edges[i + 1]]]),
                    "tokens": int(totals.sum()) if told else 0,
                    "words": int((totals > 0).sum()) if told else 0,
                }
            )
    schema = [("chunk", pa.int64()), ("level", pa.int32()), ("bucket", pa.int64()), ("counts", pa.binary()), ("tokens", pa.int64()), ("words", pa.int64())]
    return pa.Table.from_pylist(found, schema=pa.schema(schema))


def _content(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, most):
            vocabulary, order, first = runs(chunk.hashes)
            tokens = numbers(order, first)
            del order, first
            yield pa.record_batch(
                {
                    "chunk": pa.array([chunk.number], pa.int64()),
                    "doc_ids": pa.array([chunk.doc_ids], pa.list_(pa.int64())),
                    "held": pa.array([chunk.held], pa.list_(pa.bool_())),
                    "sizes": pa.array([chunk.sizes], pa.list_(pa.int32())),
                    "vocabulary": pa.array([shrunk_keys(vocabulary)], pa.binary()),
                    "tokens": pa.array([shrunk(tokens.view(np.uint32))], pa.binary()),
                }
            )

    return run


@dataclass
class Automaton:
    """The part of the backoff automaton that a chunk's texts can traverse; weights are log10.

    State 0 is the empty context, the others are known contexts. An arc is named by its state and
    its word, and leads to the longest known context that its n-gram ends with. ``failure`` leads from
    a state to its context without the first word. ``unknown`` weighs a word without an arc in state 0.
    """

    order: int
    words: int
    arcs: np.ndarray  # state * words + word, ascending
    weights: np.ndarray
    targets: np.ndarray
    failure: np.ndarray
    failure_weights: np.ndarray
    start: int
    unknown: float

    def walk(self, word: np.ndarray, sizes: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """Per text the sum of the weights on its one way from left to right, from the start state.

        The texts go side by side, a word a step, and each carries its state. Without an arc for the
        word a text takes failure arcs until there is one, or the unknown word's weight in state 0. Texts longer than
        ``segment`` are walked in segments, whose first ``order - 1`` words only find the state and weigh nothing.
        """
        per_text = -(-sizes // segment)
        text = np.repeat(np.arange(len(sizes)), per_text)
        number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        warm = np.where(number > 0, self.order - 1, 0)
        begin = number * segment - warm
        length = np.minimum(sizes[text], (number + 1) * segment) - begin
        by = np.argsort(-length, kind="stable")  # those still under way come first
        at = ((np.cumsum(sizes) - sizes)[text] + begin)[by]
        warm = warm[by]
        under_way = np.searchsorted(-length[by], -np.arange(length.max(initial=0)), side="left")
        state = np.where(warm > 0, 0, self.start)
        score = np.zeros(len(by))
        for step, n in enumerate(under_way.tolist()):
            if step == self.order - 1:
                score[warm > 0] = 0
            self._step(state[:n], score[:n], word[at[:n] + step])
        return np.bincount(text[by], weights=score, minlength=len(sizes))

    def _step(self, state: np.ndarray, score: np.ndarray, word: np.ndarray) -> None:
        seeking = np.arange(len(word))
        while len(seeking):
            key = state[seeking].astype(np.int64) * self.words + word[seeking]
            place = np.searchsorted(self.arcs[:-1], key)
            found = self.arcs[place] == key
            score[seeking[found]] += self.weights[place[found]]
            state[seeking[found]] = self.targets[place[found]]
            seeking = seeking[~found]
            empty = state[seeking] == 0
            score[seeking[empty]] += self.unknown
            seeking = seeking[~empty]
            score[seeking] += self.failure_weights[state[seeking]]
            state[seeking] = self.failure[state[seeking]]


def build_automaton(chunk: Chunk, word: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], tokens: int, words: int, prior: float) -> Automaton:
    """States and arcs of the chunk's known n-grams.

    ``word`` numbers the chunk's tokens. Each level has the number of the n-gram that ends at each
    token (-1 where none does) and the training count of each number. In a state with context count t, the
    arc of an n-gram seen c times weighs (c + prior * shorter) / (t + prior), with the weight of the
    same word from the shorter context; the failure arc weighs prior / (t + prior). So the
    probabilities of all words, one unknown one included, add up to 1.
    """
    order, width = len(levels), int(word.max(initial=0)) + 1
    begins = np.zeros(len(word), bool)
    begins[np.cumsum(chunk.sizes) - chunk.sizes] = True
    ends = chunk.hashes == np.uint64(END)
    # Every training text has one END and so one START.
    texts = int(levels[0][1][levels[0][0][np.flatnonzero(ends)[0]]]) if len(word) else 0
    start = 1 if order > 1 and texts else 0
    failure, failure_weights = [np.zeros(1 + start, np.int32)], [np.zeros(1), np.full(start, np.log10(prior / (texts + prior)))]
    states = 1 + start
    size = sum(int(np.count_nonzero(count > 0)) for _, count in levels)
    arcs, weights, targets, filled = np.empty(size + 1, np.int64), np.empty(size), np.empty(size, np.int32), 0
    # The state of the level's n-gram at each token, -1 where that is no known context.
    before = after = np.zeros(len(word), np.int32)
    weight_of = None
    for level, (gram, count) in enumerate(levels, 1):
        at = np.zeros(len(count), np.int32)  # a token at which each n-gram ends
        some = np.flatnonzero(gram >= 0)
        at[gram[some]] = some
        del some
        known = np.flatnonzero(count > 0).astype(np.int32)
        at = at[known]
        if level < order:
            inner = ~ends[at]
            context = known[inner]
            state_of = np.full(len(count) + 1, -1, np.int32)  # the last one stands for no n-gram
            state_of[context] = states + np.arange(len(context))
            failure.append(after[at[inner]])
            failure_weights.append(np.log10(prior / (count[context] + prior)))
            states += len(context)
            before, after = after, state_of[gram]
            del inner, context, state_of
        else:
            before = after
        shorter_weight, weight_of = weight_of, np.zeros(len(count)) if level < order else None
        for a in range(0, len(known), ARCS):
            own_known, own_at = known[a : a + ARCS], at[a : a + ARCS]
            if level == 1:
                own, weight = np.zeros(len(own_at), np.int64), (count[own_known] + 1) / (tokens + words + 1)
            else:
                shorter, shorter_count = levels[level - 2]
                own, total = before[own_at - 1].astype(np.int64), shorter_count[shorter[own_at - 1]]
                if level == 2:
                    own, total = np.where(begins[own_at], start, own), np.where(begins[own_at], texts, total)
                weight = (count[own_known] + prior * shorter_weight[shorter[own_at]]) / (total + prior)
            if level < order:
                weight_of[own_known] = weight
            part = slice(filled + a, filled + a + len(own_at))
            arcs[part], weights[part], targets[part] = own * width + word[own_at], np.log10(weight), np.maximum(after[own_at], 0)
        # Contexts of a level are numbered behind all shorter ones, so each level's arcs are sorted by themselves.
        part = slice(filled, filled + len(at))
        filled += len(at)
        del known, at
        by = np.argsort(arcs[part])
        for values in (arcs, weights, targets):
            values[part] = values[part][by]
        del by
    arcs[-1] = -1  # what stands behind the last arc equals none
    return Automaton(
        order,
        width,
        arcs,
        weights,
        targets,
        np.concatenate(failure),
        np.concatenate(failure_weights),
        start,
        float(np.log10(1 / (tokens + words + 1))),
    )


def _score(order: int, tokens: int, words: int, prior: float):
    def run(content: pa.Table, answers: pa.Table) -> pa.Table:
        fields = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for row in content.to_pylist():
            vocabulary = grown_keys(row["vocabulary"])
            sizes = np.array(row["sizes"], np.int64)
            word = grown(row["tokens"], np.uint32).view(np.int32)
            chunk = Chunk(row["chunk"], row["doc_ids"], row["held"], sizes, vocabulary[word])
            levels = []
            for level, (key, valid) in enumerate(chunk.grams(order), 1):
                own = answers.filter(pc.equal(answers.column("level"), level)).sort_by("bucket").column("counts")
                parts = [grown(counts.as_py(), np.uint64) for counts in own]
                known = np.concatenate(parts) if parts else np.empty(0, np.uint64)
                distinct, sorting, first = runs(key[valid])
                if len(distinct) != len(known):
                    raise ValueError("the documents changed while they were scored: give a stored table")
                del key, parts, distinct
                gram = np.full(len(valid), -1, np.int32)
                gram[valid] = numbers(sorting, first)
                del valid, sorting, first
                levels.append((gram, known.view(np.int64)))
            starts = np.cumsum(sizes) - sizes
            gram, seen = levels[0]
            base = np.log10((seen + 1) / (tokens + 1 * (words + 1)))
            fields["doc_id"] += row["doc_ids"]
            fields["held_out"] += row["held"]
            fields["n_tokens"] += row["sizes"]
            fields["n_known"] += np.add.reduceat((seen > 0)[gram], starts, dtype=np.int64).tolist()
            fields["base_score"] += np.add.reduceat(base[gram], starts).tolist()
            del gram, seen, base
            automaton = build_automaton(chunk, word, levels, tokens, words, prior)
            del levels
            fields["score"] += automaton.walk(word, sizes).tolist()
        n = len(fields["doc_id"])
        return pa.table(
            {
                "doc_id": pa.array(fields["doc_id"], pa.int64()),
                "held_out": pa.array(fields["held_out"], pa.bool_()),
                "n_tokens": pa.array(fields["n_tokens"], pa.int64()),
                "n_known": pa.array(fields["n_known"], pa.int64()),
                "train_tokens": pa.array([tokens] * n, pa.int64()),
                "base_score": pa.array(fields["base_score"], pa.float64()),
                "score": pa.array(fields["score"], pa.float64()),
            }
        )

    return run


def score_documents(documents: DataFrame, held_out, order: int = ORDER, prior: float = PRIOR, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``held_out`` (a column; null counts as false) is false and scores
    all, whole texts. Null and empty texts are END alone; repeated rows count and are scored each;
    an empty table gives no rows; without training text every token is unknown. ``documents`` must
    give the same rows in the same tasks when read again, as a table does; otherwise this raises.
    """
    if order < 1 or prior <= 0:
        raise ValueError("order must be at least 1 and prior positive")
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size * order // (6 * BUCKET_KEYS)))
    asked = docs.mapInArrow(_ask(order, buckets, chunk_tokens), ASKED)
    answers = stored(asked.repartition(min(buckets, 100_000), "bucket").groupBy("bucket").applyInArrow(_answer, ANSWERED), "ngram-counts")
    totals = answers.agg(F.sum("tokens"), F.sum("words")).first()
    content = docs.mapInArrow(_content(chunk_tokens), CONTENT)
    tasks = max(1, min(100_000, -(-size // (6 * chunk_tokens)) * 2))
    left = content.repartition(tasks, "chunk").groupBy("chunk")
    right = answers.select("chunk", "level", "bucket", "counts").repartition(tasks, "chunk").groupBy("chunk")
    return left.cogroup(right).applyInArrow(_score(order, totals[0] or 0, totals[1] or 0, prior), SCORED)
