"""Scores of texts by a small causal self-attention model over subword ids.

1. Tasks cut texts into words, collect the distinct words of every chunk of some megabytes,
   and give each its subword ids (byte-level BPE, never trained here). A chunk's documents
   become places in its word list, frequent words first. Word counts of all training documents
   are summed by word, in one shuffle, and a chunk gets back those sums that differ from its
   own counts; subword counts give the model's vocabulary and the shares inside its classes.
2. The model is one attention head over context windows that overlap by half, causal and
   within a document, then a softmax over classes of subwords. Frequent subwords have
   vectors of their own and are grouped by what precedes them in all training text; the
   share of another subword in its class comes from the counts of the whole corpus.
   It is trained on every window of every training document, once: in each round the
   tasks start from the same state, make a numpy Adam step for each batch of their windows,
   drawn in runs of eight neighbours, and the mean of their states, weighted by windows, is
   the next round's. Rounds share out the files of step 1 and grow with the root of their
   number, steps grow with the text.
   A bounded sample of passages gives the state to start from, and nothing else.
3. Chunks meet the summed counts of their words and are scored: batched windows of 16
   places, each scoring its second half, so every subword is scored once. A word's
   probability is that of its subwords, given that a word begins, and that it ends after
   them. It is mixed with the word's discounted relative frequency in the training
   documents; the mass freed by the discount goes to the attention model, which knows new
   words. A text's probability is the mean over a few weights of this mixture, so a text
   chooses its weight at a cost of less than one digit.

Training documents are those whose crc32(id as text) mod 7 is not 2. What is gathered from
them (words, subwords, pairs of subwords, trained windows) covers all of them and grows with
them. `attention_score` is what the attention model gives a text without the word counts.

Defined results: a null or empty text has one token, its end; a null id is a training
document; rows that repeat an id are documents of their own; words are compared by 64-bit
hashes; without training documents, counts are 0 and the model stays at its first state;
an empty table gives an empty one; columns other than id and text play no part.
"""

from __future__ import annotations

import base64
import copy
import functools
import math
import secrets
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerlake.llm.shared import lower_ascii, written

FOLDS, HELD_OUT = 7, 2
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how byte-level BPE cuts a text before it looks up its ranks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK_BYTES = 8 << 20
#: Words that are scored at a time.
PART_WORDS = 100_000
#: The passages that give the state to start from.
SAMPLE_DOCS, SAMPLE_CHARS, MOST_SAMPLED = 1000, 16_000, 1500

#: Subwords with vectors of their own, and classes of those that begin a word or don't.
ROWS, CLUSTERS = 1500, 20
WINDOW, KEY, WIDTH = 16, 8, 24
HALF = WINDOW // 2
STEPS, BATCH, RATE, SEED = 1000, 768, 0.01, 11
TEST_STEPS = 50
#: The rate of the first round over all windows, and the steps a task takes to reach it.
ROUND_RATE, RISE = 0.01, 20
#: Windows that follow one another and are learnt together, so that they share keys and values.
RUN = 8
#: Logits up to this one have finite exponentials, and sums of them; of the other one it is 0.
LARGEST, LOWEST = 60.0, -1e4
#: Windows scored at a time.
STRIP = 1024
#: Discount of word counts, and the weights of word frequencies that are tried for a text.
DISCOUNT, WEIGHTS = 0.75, (1.0, 0.95, 0.8, 0.5, 0.2)
_END = xxhash.xxh3_64_intdigest(b" end")

_encodings: dict = {}


class Subwords:
    """The byte-level vocabulary; travels as compressed text, is built once in a process."""

    def __init__(self, packed: bytes):
        self.packed = packed

    @classmethod
    def load(cls, path: str = RANKS) -> Subwords:
        with open(path, "rb") as f:
            return cls(zlib.compress(f.read(), 9))

    def encoding(self):
        """The encoding, the id of the end, and which ids begin with a space."""
        key = xxhash.xxh3_64_intdigest(self.packed)
        if key not in _encodings:
            import tiktoken

            lines = zlib.decompress(self.packed).splitlines()
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
            begins = np.zeros(len(ranks) + 1, dtype=bool)
            begins[[i for piece, i in ranks.items() if piece[:1] == b" "]] = True
            begins[len(ranks)] = True
            own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            _encodings[key] = own, len(ranks), begins
        return _encodings[key]

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of all words, each behind a space, and how many each has."""
        own, _, begins = self.encoding()
        if not words:
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
        ids = np.array(own.encode_ordinary(" " + b" ".join(words).decode("utf-8", "replace")), dtype=np.int32)
        first = np.flatnonzero(begins[ids])
        if len(first) != len(words) or first[0]:  # only if a word holds white space of its own
            each = [own.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
            return np.array([i for e in each for i in e], dtype=np.int32), np.array([len(e) for e in each])
        return ids, np.diff(np.append(first, len(ids)))


_KINDS = "chunk long, kind int, doc_id long, held_out boolean, payload binary, word long, place int, n long"
_ARROW = pa.schema([
    ("chunk", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
    ("payload", pa.binary()), ("word", pa.int64()), ("place", pa.int32()), ("n", pa.int64()),
])
DOC, WORD, LIST, SUBWORD, TRAIN = range(5)


def _rows(chunk: int, kind: int, size: int, **columns) -> pa.RecordBatch:
    given = {"chunk": pa.array(np.full(size, chunk, dtype=np.int64)), "kind": pa.array(np.full(size, kind, dtype=np.int32)), **columns}
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(size, f.type)) for f in _ARROW], schema=_ARROW)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers as the first bytes of all, then the second ones, and so on: most of these are 0."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _of_planes(packed: pa.Buffer | bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, dtype=np.uint8).reshape(4, -1).T).view("<i4").reshape(-1)


def _places(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts as they come, the place of every word among them, and
    where each text ends."""
    words = pc.ascii_split_whitespace(pa.array([raw or b"" for raw in texts], pa.binary()).view(pa.string()))
    coded = words.flatten().dictionary_encode()
    at, distinct = coded.indices.to_numpy(), coded.dictionary.view(pa.binary()).to_pylist()
    ends = words.offsets.to_numpy()[1:].astype(np.int64)
    if b"" in distinct:  # before the first and behind the last white space of a text
        none = distinct.index(b"")
        kept = at != none
        ends = np.append(0, np.cumsum(kept))[ends]
        at = at[kept]
        at, distinct = at - (at > none), distinct[:none] + distinct[none + 1:]
    return distinct, at.astype(np.int32), ends


def _chunk_rows(ids: list, held: list[bool], texts: list[bytes | None], subwords: Subwords) -> Iterator[pa.RecordBatch]:
    """A chunk's documents as places in its word list, its words with places and training
    counts, the subwords of its words, and training counts of subwords."""
    chunk = secrets.randbits(63)
    distinct, at, ends = _places(texts)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], dtype=np.uint64).view(np.int64)
    hashes, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    at = place.astype(np.int32)[at]
    order = np.argsort(-np.bincount(at, minlength=len(hashes)), kind="stable")
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    hashes, first, at = hashes[order], first[order], place[at]
    sub, sizes = subwords.of_words([distinct[k] for k in first])
    training = np.repeat(~np.array(held), np.diff([0, *ends]))
    counts = np.bincount(at[training], minlength=len(hashes))
    n_docs = int((~np.array(held)).sum())
    yield _rows(
        chunk, DOC, len(ids), doc_id=pa.array(ids, pa.int64()), held_out=pa.array(held),
        payload=pa.array([zlib.compress(_planes(at[s:e]), 1) for s, e in zip([0, *ends], ends)], pa.binary()),
    )
    end = np.int64(np.uint64(_END))
    yield _rows(
        chunk, WORD, len(hashes) + 1, word=pa.array(np.append(hashes, end)),
        place=pa.array(np.arange(len(hashes) + 1, dtype=np.int32)), n=pa.array(np.append(counts, n_docs)),
    )
    _, last, _ = subwords.encoding()
    packed = zlib.compress(_planes(sizes) + sub.astype(_id_type(last)).tobytes(), 1)
    yield _rows(chunk, LIST, 1, payload=pa.array([packed], pa.binary()), n=pa.array([len(hashes)]))
    each = np.bincount(sub, weights=np.repeat(counts, sizes)).astype(np.int64) if len(sub) else np.empty(0, dtype=np.int64)
    used = np.flatnonzero(each)
    yield _rows(chunk, SUBWORD, len(used), word=pa.array(used), n=pa.array(each[used]))
    for ids in _training_ids([at[s:e] for s, e, out in zip([0, *ends], ends, held) if not out], sub, sizes, last):
        yield _rows(chunk, TRAIN, 1, payload=pa.array([ids.astype(_id_type(last)).tobytes()], pa.binary()), n=pa.array([len(ids)]))


def _id_type(end: int) -> type:
    return np.uint16 if end < 1 << 16 else np.int32


def _training_ids(docs: list[np.ndarray], sub: np.ndarray, sizes: np.ndarray, end: int) -> Iterator[np.ndarray]:
    """Subwords of all `docs` with an end behind each, some whole documents at a time."""
    sub, sizes = np.append(sub, end), np.append(sizes, 1)
    from_ = np.cumsum(sizes) - sizes
    cuts = np.cumsum([len(d) + 1 for d in docs]) // PART_WORDS
    for part in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(cuts)) + 1):
        if len(part):
            at = np.concatenate([np.append(docs[k], len(sizes) - 1) for k in part])
            size = sizes[at]
            yield sub[np.repeat(from_[at] - np.cumsum(size) + size, size) + np.arange(size.sum())]


def tokenised(docs: DataFrame, subwords: Subwords) -> DataFrame:
    """The rows of all chunks of `docs` (doc_id, held_out, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
                text = text.as_py()
                raw = text.encode().lower() if text else None
                ids.append(doc_id)
                held.append(out)
                texts.append(raw)
                size += len(raw or b"")
                if size >= CHUNK_BYTES:
                    yield from _chunk_rows(ids, held, texts, subwords)
                    ids, held, texts, size = [], [], [], 0
        if ids:
            yield from _chunk_rows(ids, held, texts, subwords)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _KINDS)


def _sequence(docs_sub: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray]:
    """All subwords with an end behind each document, and the number of their document."""
    ids = np.concatenate([np.append(d, end) for d in docs_sub]) if docs_sub else np.empty(0, dtype=np.int64)
    return ids.astype(np.int64), np.repeat(np.arange(len(docs_sub)), [len(d) + 1 for d in docs_sub])


class Scratch:
    """Arrays that are used again by name: new memory costs a task more than its arithmetic."""

    def __init__(self):
        self.kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, dtype: type = np.float32) -> np.ndarray:
        """An array of that shape with any content; that given before under this name is lost."""
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, dtype=dtype)
        return self.kept[name][:size].reshape(shape)

    def __reduce__(self):
        return Scratch, ()


class Adam:
    """Adam for the parameters `p`, whose arrays become parts of one long array that it changes."""

    PART = 16_384

    def __init__(self, p: dict[str, np.ndarray]):
        self.steps = 0
        size = sum(v.size for v in p.values())
        self.flat, self.slope = np.empty((2, size), dtype=np.float32)
        self.first, self.second = np.zeros((2, size), dtype=np.float32)
        self.room = np.empty(self.PART, dtype=np.float32)
        #: Where the slopes of the next step go, by parameter.
        self.slopes: dict[str, np.ndarray] = {}
        start = 0
        for k, v in p.items():
            part = slice(start, start + v.size)
            self.flat[part] = v.reshape(-1)
            p[k], self.slopes[k] = (x[part].reshape(v.shape) for x in (self.flat, self.slope))
            start += v.size

    def move(self, rate: float) -> None:
        """A step along `slopes`; some parameters at a time, as many as stay in a core's cache."""
        self.steps += 1
        by_first, by_second = (np.float32(1 / (1 - x ** self.steps)) for x in (0.9, 0.99))
        by_first *= np.float32(rate)
        for start in range(0, len(self.flat), self.PART):
            part = slice(start, start + self.PART)
            p, g, first, second = self.flat[part], self.slope[part], self.first[part], self.second[part]
            move = self.room[:len(p)]
            first *= np.float32(0.9)
            first += np.multiply(g, np.float32(0.1), out=move)
            second *= np.float32(0.99)
            g *= g
            g *= np.float32(0.01)
            second += g
            np.multiply(second, by_second, out=move)
            np.sqrt(move, out=move)
            move += np.float32(1e-8)
            np.divide(first, move, out=move)
            move *= by_first
            p -= move


def _copied(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, dtype=x.dtype.type)
    out[...] = x
    return out


class Attention:
    """Embeddings, one head, and a softmax over classes and over the members of a class.

    The most frequent subwords have vectors of their own; the others share one embedding
    and lie in two classes, where their shares are those of the corpus.
    """

    def __init__(self, counts: np.ndarray, begins: np.ndarray, vectors: np.ndarray | None = None):
        """counts: of every subword id in training; begins: ids that begin a word.

        `vectors`: for the most frequent ids, what precedes them, to group them by.
        """
        rng = np.random.default_rng(SEED)
        n, end = len(counts), len(counts) - 1
        order = np.argsort(-counts, kind="stable")
        frequent = order[(order != end) & (counts[order] > 0)][:ROWS]
        # classes that begin a word come first: the end, other ids, groups of frequent ids
        cls = np.where(begins, 1, 2 + CLUSTERS).astype(np.int32)
        cls[end] = 0
        rank = np.full(n, -1, dtype=np.int64)
        rank[frequent] = np.arange(len(frequent))
        for kind, base in ((True, 2), (False, 3 + CLUSTERS)):
            own = frequent[begins[frequent] == kind]
            x = None if vectors is None else vectors[rank[own]]
            cls[own] = base + _groups_of(own, x, rng)
        self.n_begin, self.n_classes = 2 + CLUSTERS, 3 + 2 * CLUSTERS
        # rows of frequent ids in order of their classes, so that a class is a slice
        self.members = frequent[np.argsort(cls[frequent], kind="stable")]
        size = len(self.members)
        self.row = np.full(n, size, dtype=np.int32)
        self.row[self.members] = np.arange(size)
        self.begin_row = size + 1
        self.slices = np.searchsorted(cls[self.members], np.arange(self.n_classes + 1))
        self.cls = cls
        share = counts + 0.01
        whole = np.bincount(cls, weights=share, minlength=self.n_classes)
        self.log_share = np.where(rank >= 0, 0.0, np.log(share / whole[cls])).astype(np.float32)
        p = {
            "query": rng.normal(0, 0.3, (size + 2, KEY)), "key": rng.normal(0, 0.3, (size + 2, KEY)),
            "value": rng.normal(0, 0.1, (size + 2, WIDTH)), "direct": rng.normal(0, 0.3, (size + 2, WIDTH)),
            "near": np.zeros(WINDOW), "out": rng.normal(0, 0.2, (WIDTH, self.n_classes)),
            "bias": np.log(whole / share.sum() + 1e-9),
            "inner": rng.normal(0, 0.2, (size, WIDTH)), "inner_bias": np.log(share[self.members]),
        }
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        self.scratch = Scratch()

    def __setstate__(self, state: dict) -> None:
        """Arrays are copied into new ones: the type of an array that came to a task is equal, but
        not the same object, and numpy takes slow ways then (`np.add.at` 40 times slower)."""
        self.__dict__ |= {k: _copied(v) if isinstance(v, np.ndarray) else v for k, v in state.items()}
        self.p = {k: _copied(v) for k, v in self.p.items()}

    def inputs(self, ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Embedding rows of what precedes each place: the id before, or the document's begin."""
        rows = np.empty(len(ids), dtype=np.int32)
        rows[1:] = self.row[ids[:-1]]
        starts = np.ones(len(ids), dtype=bool)
        starts[1:] = doc[1:] != doc[:-1]
        rows[starts] = self.begin_row
        return rows

    @staticmethod
    def windows(rows: np.ndarray, doc: np.ndarray, run: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and documents in windows of 16 places that begin 8 apart, and go 8 back.

        A row of the result has `run` windows, 8 * (run + 1) places.
        """
        size = run * HALF
        n = -(-len(rows) // size)
        pad = np.full(n * size + HALF, 0, dtype=np.int32)
        pad[HALF:HALF + len(rows)] = rows
        of = np.full(n * size + HALF, -1, dtype=np.int64)
        of[HALF:HALF + len(doc)] = doc
        view = np.lib.stride_tricks.sliding_window_view
        return view(pad, size + HALF)[::size], view(of, size + HALF)[::size]

    _ahead = np.arange(WINDOW)[None, :] - np.arange(HALF, WINDOW)[:, None]
    _near = np.clip(-_ahead, 0, WINDOW - 1)

    def _of(self, name: str, rows: np.ndarray) -> np.ndarray:
        p = self.p[name]
        return np.take(p, rows, axis=0, out=self.scratch(name, *rows.shape, p.shape[1]), mode="clip")

    @staticmethod
    def _by_window(x: np.ndarray) -> np.ndarray:
        """The places of each window, of places by run: a view."""
        runs, places = x.shape[:2]
        by_place = x.strides[1]
        return np.lib.stride_tricks.as_strided(
            x, (runs, places // HALF - 1, WINDOW, *x.shape[2:]), (x.strides[0], HALF * by_place, by_place, *x.strides[2:]))

    @staticmethod
    def _ones(size: int) -> np.ndarray:
        return np.ones(size, dtype=np.float32)

    def forward(self, x: np.ndarray, doc: np.ndarray) -> dict[str, np.ndarray]:
        """What the model makes of runs of windows; the arrays are good until the next call."""
        p, scratch = self.p, self.scratch
        runs, each = len(x), x.shape[1] // HALF - 1
        shape = runs, each, HALF
        last = x[:, HALF:]
        q, k, v = (self._of(name, at) for name, at in (("query", last), ("key", x), ("value", x)))
        q *= np.float32(KEY ** -0.5)
        q, k, v = q.reshape(*shape, KEY), self._by_window(k), self._by_window(v)
        score = np.matmul(q, k.swapaxes(2, 3), out=scratch("score", *shape, WINDOW))
        score += np.where(self._ahead > 0, np.float32(LOWEST), p["near"][self._near])
        of = self._by_window(doc)
        # of several documents; a short text has room before and behind it in one window
        crossing = np.nonzero((of[:, :, 0] != of[:, :, -1]) | (of[:, :, 0] < 0))
        if len(crossing[0]):
            of, mixed = of[crossing], score[crossing]
            mixed[of[:, None, :] != of[:, HALF:, None]] = LOWEST
            score[crossing] = mixed
        np.exp(score, out=score)
        flat = score.reshape(-1, WINDOW)
        total = flat @ self._ones(WINDOW)
        total += np.float32(1e-20)
        flat *= np.divide(1, total, out=total)[:, None]
        hidden = np.matmul(score, v, out=scratch("hidden", *shape, WIDTH)).reshape(runs, -1, WIDTH)
        hidden += self._of("direct", last)
        np.tanh(hidden, out=hidden)
        # a column of ones, so that biases are a row of weights
        wide = scratch("wide", runs * each * HALF, WIDTH + 1)
        wide[:, :WIDTH], wide[:, WIDTH] = hidden.reshape(-1, WIDTH), 1
        logits = np.matmul(wide, np.vstack([p["out"], p["bias"]]), out=scratch("logits", len(wide), self.n_classes))
        return {"q": q, "k": k, "v": v, "a": score, "h": hidden, "wide": wide, "logits": logits}

    def _by_class(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in order of their classes, and where each class begins there."""
        order = np.argsort(cls.astype(np.uint8 if self.n_classes < 256 else np.int32), kind="stable")
        return order, np.append(0, np.cumsum(np.bincount(cls, minlength=self.n_classes)))

    def _members(self, wide, cls, row, cuts) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
        """For places in order of their classes: logits of all members of their classes, one class
        after the other; for each class with members its places, its members and their table
        in the logits; the places that have such a class, and where the logit of their id is."""
        sizes = np.diff(self.slices)
        begins = np.append(0, np.cumsum(np.diff(cuts) * sizes))
        vectors = self.scratch("vectors", len(self.members), WIDTH + 1)
        vectors[:, :WIDTH], vectors[:, WIDTH] = self.p["inner"], self.p["inner_bias"]
        logits, tables = self.scratch("inner", begins[-1]), []
        for c in np.flatnonzero(np.diff(begins)):
            at, members = slice(cuts[c], cuts[c + 1]), slice(self.slices[c], self.slices[c + 1])
            table = logits[begins[c]:begins[c + 1]].reshape(-1, sizes[c])
            tables.append((at, members, np.matmul(wide[at], vectors[members].T, out=table)))
        inside = np.flatnonzero(sizes[cls])
        cls = cls[inside]
        return logits, tables, inside, begins[cls] + (inside - cuts[cls]) * sizes[cls] + row[inside] - self.slices[cls]

    @staticmethod
    def _exp(x: np.ndarray) -> None:
        """Makes x in place its exponentials, up to a factor for each row if they are large."""
        if x.max(initial=0.0) > LARGEST:
            x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)

    def score(self, ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each id, and of a word beginning (or the end) at its place."""
        run = -(-len(ids) // HALF)
        x, of = self.windows(self.inputs(ids, doc), doc, max(run, 1))
        cls, row = np.zeros((2, run * HALF), dtype=np.int32)
        cls[:len(ids)], row[:len(ids)] = self.cls[ids], self.row[ids]
        own, begin = np.empty((2, len(cls)), dtype=np.float32)
        sums = np.ones((self.n_classes, 2), dtype=np.float32)
        sums[self.n_begin:, 1] = 0
        for s in range(0, len(cls), STRIP * HALF):
            places = slice(s, s + STRIP * HALF)
            seen = slice(s, s + STRIP * HALF + HALF)
            own[places], begin[places] = self._strip(x[:, seen], of[:, seen], cls[places], row[places], sums)
        return own[:len(ids)] + self.log_share[ids], begin[:len(ids)]

    def _strip(self, x, of, cls, row, sums) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of the class and its member at each place, and of a beginning."""
        f, scratch = self.forward(x, of), self.scratch
        logits, n = f["logits"], len(cls)
        value = logits.reshape(-1).take(np.arange(0, n * self.n_classes, self.n_classes) + cls)
        np.exp(logits, out=logits)
        total, beginning = (logits @ sums).T
        total = np.log(total)
        value -= total
        order, cuts = self._by_class(cls)
        wide = np.take(f["wide"], order, axis=0, out=scratch("sorted", *f["wide"].shape), mode="clip")
        inner, tables, inside, at_own = self._members(wide, cls[order], row[order], cuts)
        picked, within = scratch("picked", n), scratch("within", n)
        picked[:], within[:] = 0, 1
        picked[inside] = inner[at_own]
        np.exp(inner, out=inner)
        for at, _, table in tables:
            np.matmul(table, self._ones(table.shape[1]), out=within[at])
        picked -= np.log(within, out=within)
        value[order] += picked
        return value, np.log(beginning) - total

    def train(self, ids: np.ndarray, doc: np.ndarray) -> None:
        """Adam on random batches of windows; the loss is the mean cross entropy.

        A tenth of the windows is set aside; the state that does best on it stays.
        """
        x, of = self.windows(self.inputs(ids, doc), doc)
        cls = np.zeros(len(x) * HALF, dtype=np.int64)
        cls[:len(ids)] = self.cls[ids]
        row = np.zeros(len(cls), dtype=np.int64)
        row[:len(ids)] = self.row[ids]
        real = (of[:, HALF:] >= 0).reshape(-1)
        rng = np.random.default_rng(SEED)
        aside = np.arange(len(x)) // 64 % 10 == 9
        use, tests = np.flatnonzero(~aside), np.flatnonzero(aside)[:4096]
        best, kept = np.inf, None
        adam, places_of = Adam(self.p), self._places_of
        for step in range(1, STEPS + 1):
            pick = use[rng.integers(0, len(use), BATCH)]
            places = places_of(pick)
            self._gradient(x[pick], of[pick], cls[places], row[places], real[places], adam.slopes)
            adam.move(RATE * min(1.0, 2 * (1 - step / (STEPS + 1))))
            if len(tests) and step % TEST_STEPS == 0:
                at = places_of(tests)
                loss = self._loss(x[tests], of[tests], cls[at], row[at], real[at])
                if loss < best:
                    best, kept = loss, {k: v.copy() for k, v in self.p.items()}
        self.p = kept or self.p

    @staticmethod
    def _places_of(windows: np.ndarray) -> np.ndarray:
        return (windows[:, None] * HALF + np.arange(HALF)).reshape(-1)

    def learn(self, ids: np.ndarray, adam: Adam, rate: float, rng: np.random.Generator) -> int:
        """Steps of `adam` over all windows of whole documents, each window once."""
        ends = ids == len(self.cls) - 1
        doc = np.cumsum(ends) - ends
        x, of = self.windows(self.inputs(ids, doc), doc, RUN)
        cls, row = np.zeros((2, len(x), RUN * HALF), dtype=np.int32)
        cls.reshape(-1)[:len(ids)], row.reshape(-1)[:len(ids)] = self.cls[ids], self.row[ids]
        for pick in np.array_split(rng.permutation(len(x)), -(-len(x) * RUN // BATCH)):
            real = (of[pick, HALF:] >= 0).reshape(-1)
            self._gradient(x[pick], of[pick], cls[pick].reshape(-1), row[pick].reshape(-1), real, adam.slopes)
            adam.move(rate * min(1.0, (adam.steps + 1) / RISE))
        return -(-len(ids) // HALF)

    def _loss(self, x, of, cls, row, real) -> float:
        f = self.forward(x, of)
        logits, wide = f["logits"], f["wide"]
        value = logits[np.arange(len(logits)), cls] - np.log(np.exp(logits).sum(axis=1))
        order, cuts = self._by_class(cls)
        inner, tables, inside, at_own = self._members(wide[order], cls[order], row[order], cuts)
        value[order[inside]] += inner[at_own]
        for at, _, table in tables:
            value[order[at]] -= np.log(np.exp(table).sum(axis=1))
        return float(-(value * real).sum() / max(real.sum(), 1))

    def _gradient(self, x, of, cls, row, real, slopes: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
        """Slopes of the mean loss over runs of windows, in the arrays of `slopes` if given."""
        p, scratch, f = self.p, self.scratch, self.forward(x, of)
        slopes = slopes or {k: np.empty(v.shape, dtype=np.float32) for k, v in p.items()}
        g, h, wide = f["logits"], f["h"], f["wide"]
        n = len(cls)
        share = (real / max(real.sum(), 1)).astype(np.float32)
        # exponentials less their sum at the place that came, and a factor for each row
        self._exp(g)
        total = g @ self._ones(g.shape[1])
        g.reshape(-1)[np.arange(0, g.size, g.shape[1]) + cls] -= total
        scale = np.divide(share, total, out=total)[:, None]
        of_out = np.multiply(wide, scale, out=scratch("sorted", *wide.shape)).T @ g
        slopes["out"][:], slopes["bias"][:] = of_out[:WIDTH], of_out[WIDTH]
        back = np.matmul(g, p["out"].T, out=scratch("back", n, WIDTH))
        back *= scale
        order, cuts = self._by_class(cls)
        wide = np.take(wide, order, axis=0, out=scratch("sorted", *wide.shape), mode="clip")
        inner, tables, inside, at_own = self._members(wide, cls[order], row[order], cuts)
        if inner.max(initial=0.0) > LARGEST:
            for _, _, table in tables:
                table -= table.max(axis=1, keepdims=True)
        np.exp(inner, out=inner)
        total = scratch("within", n)
        total[:] = 1
        for at, _, table in tables:
            np.matmul(table, self._ones(table.shape[1]), out=total[at])
        inner[at_own] -= total[inside]
        scale = np.divide(share[order], total, out=total)[:, None]
        wide *= scale
        by_class, of_inner = scratch("by_class", n, WIDTH), scratch("of_inner", len(self.members), WIDTH + 1)
        by_class[:], of_inner[:] = 0, 0
        for at, members, table in tables:
            np.matmul(table, p["inner"][members], out=by_class[at])
            np.matmul(table.T, wide[at], out=of_inner[members])
        by_class *= scale
        slopes["inner"][:], slopes["inner_bias"][:] = of_inner[:, :WIDTH], of_inner[:, WIDTH]
        from_ = scratch("from", n, dtype=np.int64)
        from_[order] = np.arange(n)
        back += np.take(by_class, from_, axis=0, out=scratch("sorted", n, WIDTH), mode="clip")
        flat_h = h.reshape(-1, WIDTH)
        np.multiply(flat_h, flat_h, out=flat_h)
        np.subtract(1, flat_h, out=flat_h)
        back *= flat_h
        weights, shape = f["a"], f["a"].shape[:3]
        by_window = back.reshape(*shape, WIDTH)
        by_score = np.matmul(by_window, f["v"].swapaxes(2, 3), out=scratch("by_score", *weights.shape))
        by_score *= weights
        mean = by_score.reshape(-1, WINDOW) @ self._ones(WINDOW)
        by_score -= np.multiply(weights, mean.reshape(*shape, 1), out=scratch("by_mean", *weights.shape))
        by_place = self._ones(len(mean) // HALF) @ by_score.reshape(-1, HALF * WINDOW)
        slopes["near"][:] = np.bincount(self._near.reshape(-1), weights=by_place, minlength=WINDOW)
        by_query = np.matmul(by_score, f["k"], out=scratch("by_query", *shape, KEY))
        by_query *= np.float32(KEY ** -0.5)
        by_key = np.matmul(by_score.swapaxes(2, 3), f["q"], out=scratch("by_key", *shape[:2], WINDOW, KEY))
        to_value = np.matmul(weights.swapaxes(2, 3), by_window, out=scratch("to_value", *shape[:2], WINDOW, WIDTH))
        last = x[:, HALF:]
        self._add_rows(slopes["query"], last, by_query)
        self._add_rows(slopes["key"], x, self._by_run(by_key, "keys"))
        self._add_rows(slopes["value"], x, self._by_run(to_value, "values"))
        self._add_rows(slopes["direct"], last, back)
        return slopes

    def _by_run(self, by_window: np.ndarray, name: str) -> np.ndarray:
        """Sums by place of what its two windows have for it."""
        runs, each, _, width = by_window.shape
        halves = by_window.reshape(runs, each, 2, HALF * width)
        out = self.scratch(name, runs, each + 1, HALF * width)
        out[:, :each], out[:, each] = halves[:, :, 0], 0
        out[:, 1:] += halves[:, :, 1]
        return out

    def _add_rows(self, out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        """Makes `out` the sums of values by row; two numbers are added at a time, as a complex one."""
        width = out.shape[1] // 2
        at = self.scratch(f"at {width}", rows.size, width, dtype=np.int64)
        np.take(_places_in(len(out), width), rows.reshape(-1), axis=0, out=at, mode="clip")
        out[:] = 0
        np.add.at(out.reshape(-1).view(np.complex64), at.reshape(-1), values.reshape(-1).view(np.complex64))


@functools.cache
def _places_in(rows: int, width: int) -> np.ndarray:
    """The places of a table, by row."""
    return np.arange(rows * width).reshape(rows, width)


def _groups_of(ids: np.ndarray, vectors: np.ndarray | None, rng) -> np.ndarray:
    """Groups of ids with like predecessors (k-means), or by number without vectors."""
    if vectors is None or len(ids) <= CLUSTERS:
        return np.arange(len(ids)) % CLUSTERS
    centres = vectors[rng.choice(len(ids), CLUSTERS, replace=False)].copy()
    for _ in range(20):
        near = ((vectors[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(CLUSTERS):
            if (near == c).any():
                centres[c] = vectors[near == c].mean(axis=0)
    return near


CONTEXTS = 256


def _ranked(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Of every id its rank among the frequent ones, or their number, and that number."""
    order = np.argsort(-counts, kind="stable")
    order = order[(order != len(counts) - 1) & (counts[order] > 0)][:ROWS]
    rank = np.full(len(counts), len(order))
    rank[order] = np.arange(len(order))
    return rank, len(order)


def _pairs(ids: np.ndarray, rank: np.ndarray, size: int) -> np.ndarray:
    """How often each frequent id comes behind each of the most frequent ones."""
    before, after = rank[ids[:-1]], rank[ids[1:]]
    keep = (before < min(CONTEXTS, size)) & (after < size)
    return np.bincount(after[keep] * CONTEXTS + before[keep], minlength=size * CONTEXTS)


def _predecessors(table: np.ndarray) -> np.ndarray:
    """What precedes each frequent id, in a few dimensions; by rank of frequency."""
    table = table.reshape(-1, CONTEXTS)
    expected = table.sum(axis=1, keepdims=True) * table.sum(axis=0, keepdims=True) / max(table.sum(), 1)
    gain = np.log((table + 0.5) / (expected + 0.5))
    u, s, _ = np.linalg.svd(gain, full_matrices=False)
    return u[:, :12] * s[:12]


def _summed(rows: DataFrame, n_files: int, size: int, of_task: Callable) -> tuple[int, np.ndarray]:
    """The sums over all tasks of what `of_task` makes of the payloads that a task reads:
    a number, and `size` numbers. They are added in groups of tasks first, so that the
    driver gets about the root of their number."""
    groups = max(1, math.isqrt(n_files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = of_task(x.as_buffer() for batch in batches for x in batch.column("payload"))
        if n:
            yield pa.RecordBatch.from_pydict({
                "g": pa.array([TaskContext.get().partitionId() % groups], pa.int32()), "n": pa.array([n], pa.int64()),
                "sums": pa.array([sums.astype(np.float64).tobytes()], pa.binary()),
            })

    def add(tasks: pa.Table) -> pa.Table:
        sums = np.zeros(size)
        for x in tasks.column("sums"):
            sums += np.frombuffer(x.as_buffer())
        n = sum(tasks.column("n").to_pylist())
        return pa.table({"n": pa.array([n], pa.int64()), "sums": pa.array([sums.tobytes()], pa.binary())})

    tasks = rows.where(f"kind = {TRAIN}").select("payload").mapInArrow(run, "g int, n long, sums binary")
    n, sums = 0, np.zeros(size)
    for row in tasks.groupBy("g").applyInArrow(add, "n long, sums binary").toLocalIterator():
        n += row["n"]
        sums += np.frombuffer(row["sums"])
    return n, sums


def trained(rows: DataFrame, counts: np.ndarray, passages: list[list[bytes]], subwords: Subwords) -> Attention:
    """The model after a pass over all training windows of `rows`, a written table."""
    _, end, begins = subwords.encoding()
    kind = _id_type(end)
    files = sorted(unquote(f) for f in rows.inputFiles())
    rank, size = _ranked(counts)

    def pairs_of(payloads: Iterator[pa.Buffer]) -> tuple[int, np.ndarray]:
        n, table = 0, np.zeros(size * CONTEXTS, dtype=np.int64)
        for payload in payloads:
            ids = np.frombuffer(payload, dtype=kind)
            n += len(ids)
            table += _pairs(ids, rank, size)
        return n, table

    n, table = _summed(rows, len(files), size * CONTEXTS, pairs_of)
    if n < 2 or not size:
        return Attention(counts, begins)
    model = Attention(counts, begins, _predecessors(table))
    ids, doc = _sequence([subwords.of_words(words)[0] for words in passages], end)
    if len(ids) > 1:
        model.train(ids, doc)
    rounds = max(1, math.isqrt(len(files)) // 2)
    for r in range(rounds):
        share = rows.sparkSession.read.schema(rows.schema).parquet(*files[r::rounds])
        n, state = _summed(share, len(files[r::rounds]), sum(v.size for v in model.p.values()), _round_of(model, r, rounds, kind))
        if n:
            model.p = _unpacked(state / n, model.p)
    return model


def _round_of(model: Attention, r: int, rounds: int, kind: type) -> Callable:
    rate = ROUND_RATE * (1 - r / rounds)

    def learnt(payloads: Iterator[pa.Buffer]) -> tuple[int, np.ndarray]:
        """Windows met, and so many times the state that they lead to."""
        own, rng = copy.copy(model), np.random.default_rng([SEED, r])
        adam = Adam(own.p)
        n = sum(own.learn(np.frombuffer(x, dtype=kind).astype(np.int64), adam, rate, rng) for x in payloads)
        return n, n * np.concatenate([v.reshape(-1) for v in own.p.values()]).astype(np.float64)

    return learnt


def _unpacked(state: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    cuts = np.cumsum([v.size for v in like.values()])[:-1]
    return {k: x.reshape(v.shape).astype(np.float32) for (k, v), x in zip(like.items(), np.split(state, cuts))}


def _scores(docs: pa.Table, words: pa.Table, model: Attention, n_all: int, n_distinct: int) -> pa.Table:
    """Scores of a chunk's documents; `words` has the places of sums that are not its own counts."""
    kinds = docs.column("kind").to_numpy()
    lists = docs.filter(pa.array(kinds == LIST))
    docs = docs.filter(pa.array(kinds == DOC))
    n_words, end = lists.column("n")[0].as_py(), len(model.cls) - 1
    packed = zlib.decompress(lists.column("payload")[0].as_buffer())
    sizes = np.append(_of_planes(packed[:4 * n_words]), 1).astype(np.int64)
    sub = np.append(np.frombuffer(packed[4 * n_words:], dtype=_id_type(end)).astype(np.int32), end)
    # the end is the last word
    places = [np.append(_of_planes(zlib.decompress(x.as_buffer())), n_words) for x in docs.column("payload")]
    learnt = [x for x, out in zip(places, docs.column("held_out").to_pylist()) if not out]
    counts = np.bincount(np.concatenate([np.empty(0, dtype=np.int32), *learnt]), minlength=n_words + 1).astype(np.float64)
    for own, totals in zip(words.column("places"), words.column("totals")):  # one row, or none
        counts[own.values.to_numpy()] = totals.values.to_numpy()
    n_tokens = np.array([len(x) for x in places])
    parts = np.searchsorted(np.cumsum(n_tokens), np.arange(1, n_tokens.sum() // PART_WORDS + 1) * PART_WORDS)
    results = []
    for part in np.split(np.arange(len(places)), np.unique(parts)):
        if len(part):
            mine = [places[k] for k in part]
            results.append(_scores_of(mine, counts, sizes, sub, model, n_all, n_distinct))
    known, base, score, attention = (np.concatenate(c) for c in zip(*results))
    return pa.table({
        "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": n_tokens, "n_known": known,
        "train_tokens": np.full(len(places), n_all), "base_score": base, "score": score,
        "attention_score": attention,
    })


def _scores_of(places, counts, sizes, sub, model: Attention, n_all: int, n_distinct: int) -> tuple[np.ndarray, ...]:
    """Known words, base score, score and the attention model's own score of texts given as
    places in the word list."""
    at = np.concatenate(places).astype(np.int64)
    n_tokens = np.array([len(x) for x in places])
    first_word = np.cumsum(n_tokens) - n_tokens
    size = sizes[at]
    first_sub = np.cumsum(size) - size
    from_ = (np.cumsum(sizes) - sizes)[at]
    ids = sub[np.repeat(from_ - first_sub, size) + np.arange(size.sum())].astype(np.int64)
    doc = np.repeat(np.arange(len(places)), np.add.reduceat(size, first_word))
    own, begin = model.score(ids, doc)
    of_word = np.add.reduceat(own, first_sub, dtype=np.float64) - begin[first_sub]
    after = np.append(begin[first_sub[1:]], 0.0)
    after[first_word[1:] - 1] = 0.0
    of_word = np.minimum(of_word + after, 0.0)
    count = counts[at]
    base = np.log10((count + 1) / (n_all + n_distinct + 1))
    frequency = np.maximum(count - DISCOUNT, 0.0) / max(n_all, 1)
    spelled = np.exp(np.maximum(of_word, -700.0))
    freed = DISCOUNT * n_distinct / n_all if n_all else 1.0
    mixed = np.stack([
        np.add.reduceat(np.log10(w * frequency + (1 - w + w * freed) * spelled), first_word) for w in WEIGHTS
    ])
    best = mixed.max(axis=0)
    score = best + np.log10((10.0 ** (mixed - best)).mean(axis=0))
    attention = np.add.reduceat(of_word, first_word) / np.log(10)
    return np.add.reduceat((count > 0).astype(np.int64), first_word), np.add.reduceat(base, first_word), score, attention


def summed_words(rows: DataFrame) -> DataFrame:
    """One row `known` for every word of the training documents, and for every chunk the places
    and sums of its words that other chunks have in training documents too."""
    same = Window.partitionBy("word")
    sums = rows.where(f"kind = {WORD}").select(
        "chunk", "place", "n", F.sum("n").over(same).alias("total"), F.min("chunk").over(same).alias("first"))
    elsewhere = F.col("total") > F.col("n")
    known = (F.col("chunk") == F.col("first")) & (F.col("total") > 0)
    return sums.where(known | elsewhere).select(
        known.alias("known"), *[F.when(elsewhere, F.col(c)).alias(c) for c in ("chunk", "place", "total")])


def scored(docs: DataFrame, subwords: Subwords | None = None) -> DataFrame:
    """The scores of every row of `docs` (doc_id, text)."""
    subwords = subwords or Subwords.load()
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", out.alias("held_out"))
    rows = written(tokenised(docs, subwords), "lm-tokens", "zstd")
    words = written(summed_words(rows), "lm-counts", "zstd")
    n_distinct = words.where("known").count()
    ours = rows.where(f"kind = {WORD}")
    end_hash = int(np.int64(np.uint64(_END)))
    sums = ours.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("word") == end_hash, F.col("n"))).alias("docs")).head()
    n_all, n_docs = sums["n"] or 0, sums["docs"] or 0

    _, end, _ = subwords.encoding()
    counts = np.zeros(end + 1)
    counts[end] = n_docs
    for word, n in rows.where(f"kind = {SUBWORD}").groupBy("word").agg(F.sum("n")).collect():  # at most the vocabulary
        counts[word] = n
    rate = min(1.0, SAMPLE_DOCS / max(n_docs, 1))
    low = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1 << 53)) < F.lit(int(rate * (1 << 53)))
    chosen = docs.where(~F.col("held_out") & low)
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    passages = chosen.select(lower_ascii(F.substr("text", start, F.lit(SAMPLE_CHARS))).alias("t")).limit(MOST_SAMPLED).collect()
    model = trained(rows, counts, [r["t"].encode().split() for r in passages if r["t"]], subwords)

    back = words.where("chunk is not null").groupBy(F.col("chunk").alias("of_chunk"))
    back = back.agg(F.collect_list("place").alias("places"), F.collect_list("total").alias("totals"))
    parts = rows.where(f"kind in ({DOC}, {LIST})").select("chunk", "kind", "doc_id", "held_out", "payload", "n")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scores(left, right, model, n_all, n_distinct)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema += ", attention_score double"
    return parts.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(run, schema)
