"""SentencePiece encoding and decoding with the n best segmentations.

A text is a lattice of vocabulary pieces. Forward Viterbi gives, for every position, the
best score of a path from the start to it. A backward A* search from the end uses these
scores as heuristics; they are exact, so complete paths leave the agenda from best to
worst, and the first n are the n best segmentations. A path's score is the sum of its
pieces' scores in the model file; a character that no piece covers is written as its UTF-8
bytes, at a score below all pieces.

The lattice of a text falls apart wherever two characters meet that are side by side in no
piece. Each part is searched once and kept for later occurrences, in a store of bounded
size; the n best of a text, ids and scores, follow from the n best of its parts. Each of its
paths is decoded as a whole and compared with the text.

Encoding is exact: decoding gives the text back, with any white space and control
characters, and also where it holds the meta symbol that pieces use for a space.

The driver reads the model (its path is a parameter) and sends the pieces along; tasks work
on their rows alone, with no shuffle. Defined results: a null text has null ids and scores
and counts as exact; an empty text has no pieces and score 0; ties go to the path whose
last pieces begin further left, and behind the best to any of the equals; repeated rows give repeated results; other columns are
carried, and derived names replace clashing ones.
"""

from __future__ import annotations

import gc
import sys
from bisect import insort
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.shared import carried, quoted

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
#: Parts kept for later occurrences in each of two generations, and their most characters.
STORE, STORED_CHARS = 350_000, 48
#: Characters of new parts, and bytes of texts, that are searched at once.
AT_ONCE, SLICE_BYTES = 1 << 17, 1 << 20
#: Parts whose next bests are kept.
NEXT_BESTS = 50_000
SPACE = "▁"
#: How far the score of byte fallback lies below that of the last piece.
BELOW = 10.0

DERIVED = ["ids", "n_pieces", "score", "best_scores", "best_ids", "exact"]


class Pieces:
    """Vocabulary and scores of a model, and the search on its lattices."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], n_best: int = N_BEST):
        self.pieces, self.scores, self.kinds, self.n_best = pieces, scores, kinds, n_best
        self.ready = False

    @classmethod
    def load(cls, path: str = MODEL, n_best: int = N_BEST) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())

        def kind(i):
            if model.is_byte(i):
                return "byte"
            return "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece"

        return cls([model.id_to_piece(i) for i in every], [model.get_score(i) for i in every], [kind(i) for i in every], n_best)

    def __getstate__(self):
        return self.pieces, self.scores, self.kinds, self.n_best

    def __setstate__(self, state):
        self.__init__(*state)

    def prepare(self) -> None:
        """Look-up tables, made once in each process."""
        if self.ready:
            return
        trie: dict = {}
        self.bytes_of = [b""] * len(self.pieces)
        self.byte_ids = [0] * 256
        self.together: set[str] = set()
        usual = []
        for i, (piece, score, kind) in enumerate(zip(self.pieces, self.scores, self.kinds)):
            if kind == "byte":
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif kind == "piece":
                plain = piece.replace(SPACE, " ")
                self.bytes_of[i] = plain.encode()
                self.together.update(plain[k - 1:k + 1] for k in range(1, len(plain)))
                node = trie
                for character in plain:
                    node = node.setdefault(character, {})
                node[""] = (i, score)
                if score > -1e6:
                    usual.append(score)
        self.trie = _packed(trie)
        self.steps = _Steps(self.trie)
        # whether no piece crosses into a space, so that parts are at most a word and its spaces
        self.cut_at_spaces = not any("\n" in pair or pair[1] == " " != pair[0] for pair in self.together)
        # the same pairs as bits, by the numbers of their characters
        characters = sorted({c for pair in self.together for c in pair})
        self.number = np.zeros(sys.maxunicode + 1, dtype=np.uint16)
        self.number[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.base = len(characters) + 1
        bits = np.zeros(self.base * self.base, dtype=bool)
        pairs = np.array([[ord(c) for c in pair] for pair in self.together], dtype=np.int64).reshape(-1, 2)
        bits[self.number[pairs[:, 0]].astype(np.int64) * self.base + self.number[pairs[:, 1]]] = True
        self.bits = np.packbits(bits, bitorder="little")
        self.fallback = min(usual, default=0.0) - BELOW
        self.store: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.next_bests: dict[str, list] = {}
        self.ready = True

    def edges(self, text: str) -> tuple[list[float], list[list[tuple]]]:
        """Forward Viterbi: best score to each position, and the edges that end there."""
        n, trie, fallback = len(text), self.trie, self.fallback
        alpha = [-float("inf")] * (n + 1)
        alpha[0] = 0.0
        ends: list[list[tuple]] = [[] for _ in range(n + 1)]
        for i in range(n):
            base, node = alpha[i], trie
            for j in range(i, n):
                entry = node.get(text[j])
                if entry is None:
                    break
                node, piece, score = entry
                if piece >= 0:
                    ends[j + 1].append((i, piece, score))
                    if base + score > alpha[j + 1]:
                        alpha[j + 1] = base + score
                if node is None:
                    break
            if not ends[i + 1] or ends[i + 1][-1][0] != i:
                ends[i + 1].append((i, -1, fallback))
                if base + fallback > alpha[i + 1]:
                    alpha[i + 1] = base + fallback
        return alpha, ends

    def paths(self, text: str) -> list[tuple[float, list[int]]]:
        """The n best segmentations as (score, ids), best first.

        An entry of the agenda stands for paths that share their end; its value is the
        score of the best of them. So no more entries are kept than paths are missing.
        """
        self.prepare()
        alpha, ends = self.edges(text)
        left = self.n_best
        # ascending: the best entry is the last one; at equal value the leftmost position is
        agenda = [(alpha[-1], -len(text), 0, 0.0, None)]
        count = 0
        found: list[tuple[float, list[int]]] = []
        while agenda and left:
            _, at, _, done, link = agenda.pop()
            if at == 0:
                ids: list[int] = []
                while link:
                    piece, start, stop, link = link
                    ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in text[start:stop].encode()]
                found.append((done, ids))
                left -= 1
                continue
            for start, piece, score in ends[-at]:
                total = done + score
                value = total + alpha[start]
                if len(agenda) >= left:
                    if value <= agenda[0][0]:
                        continue
                    del agenda[0]
                count -= 1
                insort(agenda, (value, -start, count, total, (piece, start, -at, link)))
        return found

    def first(self, text: str) -> tuple:
        """ids as bytes and score of the best path, and how far the second best lies behind.

        This is the search up to its first complete path. What it leaves on the agenda are
        departures from that path, each at the exact score of its best completion.
        """
        alpha, ends = self.edges(text)
        at, done, best, second = len(text), 0.0, alpha[-1], -float("inf")
        ids: list[int] = []
        while at:
            chosen = None
            for edge in ends[at]:  # by start, so the leftmost of equals is met first
                value = done + edge[2] + alpha[edge[0]]
                if chosen is None and value >= best:
                    chosen = edge
                elif value > second:
                    second = value
            start, piece, score = chosen
            ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(text[start:at].encode())]
            done += score
            at = start
        ids.reverse()
        return np.array(ids, dtype=np.int32).tobytes(), best, best - second

    def firsts(self, texts: list[str]) -> list[tuple]:
        """`first` of many short texts at once: the same search, a step of all texts at a time."""
        if not texts:
            return []
        size = np.array([len(t) for t in texts])
        last = np.cumsum(size + 1) - 1  # positions of all texts lie in a row, one more than characters
        begin = last - size
        at = np.arange(last[-1] + 1)
        of = np.repeat(np.arange(len(texts)), size + 1)
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)

        start, node, parts = np.delete(at, last), 0, []
        alone = np.ones(len(at), dtype=bool)
        for depth in range(int(size.max())):
            stop = start + depth
            inside = stop < last[of[start]]
            start, stop, node = start[inside], stop[inside], node if depth == 0 else node[inside]
            found, row = self.steps.find(node, codes[stop])
            start, stop = start[found], stop[found]
            piece, node = self.steps.piece[row], self.steps.child[row]
            whole = piece >= 0
            if depth == 0:
                alone[start[whole]] = False
            parts.append((start[whole], stop[whole] + 1, piece[whole], self.steps.score[row[whole]]))
            more = node >= 0
            start, node = start[more], node[more]
            if not len(start):
                break
        alone[last] = False
        bare = np.flatnonzero(alone)
        parts.append((bare, bare + 1, np.full(len(bare), -1), np.full(len(bare), self.fallback)))
        src, dst, piece, score = (np.concatenate(c) for c in zip(*parts))
        place = dst - begin[of[dst]]
        order = np.argsort((place * len(at) + dst) * (STORED_CHARS + 1) - (dst - src), kind="stable")
        src, dst, piece, score, place = src[order], dst[order], piece[order], score[order], place[order]

        # forward: edges by the place where they end, then by text, then by start
        groups = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
        edges = np.zeros(len(at), dtype=np.int64)
        edges[dst[groups]] = groups
        degree = np.bincount(dst, minlength=len(at))
        alpha = np.zeros(len(at))
        by_place = np.searchsorted(place, np.arange(1, int(size.max()) + 2))
        by_group = np.searchsorted(groups, by_place)
        for k in range(len(by_place) - 1):
            s, e = by_place[k], by_place[k + 1]
            own = groups[by_group[k]:by_group[k + 1]]
            alpha[dst[own]] = np.maximum.reduceat(alpha[src[s:e]] + score[s:e], own - s)

        # backward: the leftmost of the best edges is taken, the others are departures
        best, second, done = alpha[last], np.full(len(texts), -np.inf), np.zeros(len(texts))
        here, active, taken = last.copy(), np.flatnonzero(size > 0), []
        while len(active):
            n = degree[here[active]]
            from_ = np.cumsum(n) - n
            flat = np.repeat(edges[here[active]] - from_, n) + np.arange(n.sum())
            text = np.repeat(active, n)
            value = done[text] + score[flat] + alpha[src[flat]]
            chosen = np.minimum.reduceat(np.where(value >= best[text], np.arange(len(flat)), len(flat)), from_)
            value[chosen] = -np.inf
            second[active] = np.maximum(second[active], np.maximum.reduceat(value, from_))
            edge = flat[chosen]
            taken.append((active, piece[edge]))
            done[active] += score[edge]
            here[active] = src[edge]
            active = active[here[active] > begin[active]]
        text, ids = (np.concatenate(c)[::-1] for c in zip(*taken))  # from the first piece on
        order = np.argsort(text, kind="stable")
        packed = ids[order].astype(np.int32).tobytes()
        ends = (np.cumsum(np.bincount(text, minlength=len(texts))) * 4).tolist()
        out = [(packed[a:b], x, y) for a, b, x, y in zip([0, *ends], ends, best.tolist(), (best - second).tolist())]
        for k in np.unique(text[ids < 0]).tolist():  # pieces that are written as bytes
            out[k] = self.first(texts[k])
        return out

    def learn(self, texts: list[str]) -> None:
        """Puts the parts among `texts` that are not stored into the store, all at once."""
        new = [t for t in texts if t not in self.store and t not in self.older and len(t) <= STORED_CHARS]
        inner = {t: [t[a:b] for a, b in zip(cuts, cuts[1:])] for t in new for cuts in [self.cuts(t)]}
        wholes = {x for found in inner.values() for x in found}.difference(self.store)
        wholes = [x for x in wholes if x not in self.older]
        for start, stop in _runs(np.array([len(x) for x in wholes], dtype=np.int64), AT_ONCE):
            for x, known in zip(wholes[start:stop], self.firsts(wholes[start:stop])):
                self.kept(x, known)
        for t, found in inner.items():
            if len(found) > 1:
                self.part(t, found)

    def cuts(self, text: str) -> list[int]:
        """0, the places where no piece can cross, and the length."""
        together = self.together
        return [0, *[k for k in range(1, len(text)) if text[k - 1:k + 1] not in together], len(text)]

    def part(self, text: str, inner: list[str] | None = None) -> tuple:
        known = self.store.get(text) or self.older.get(text)
        if not known:
            if inner is None:
                cuts = self.cuts(text)
                inner = [text[a:b] for a, b in zip(cuts, cuts[1:])]
            if len(inner) > 1:
                found = [self.whole(x) for x in inner]
                known = b"".join([p[0] for p in found]), sum([p[1] for p in found]), min([p[2] for p in found])
            else:
                return self.whole(text)
        return self.kept(text, known)

    def whole(self, text: str) -> tuple:
        """A part that pieces can cross everywhere."""
        return self.kept(text, self.store.get(text) or self.older.get(text) or self.first(text))

    def kept(self, text: str, known: tuple) -> tuple:
        if len(text) <= STORED_CHARS:
            if len(self.store) >= STORE:
                self.older, self.store = self.store, {}
            self.store[text] = known
        return known

    def others(self, text: str) -> list[tuple[float, bytes]]:
        """The next bests of a part: how far each lies behind the best, and its ids."""
        found = self.next_bests.get(text)
        if found is None:
            cuts = self.cuts(text)
            if len(cuts) > 2:
                inner = [text[a:b] for a, b in zip(cuts, cuts[1:])]
                parts = [self.part(x) for x in inner]
                best = [p[0] for p in parts]
                found = [(distance, b"".join([departed.get(k, ids) for k, ids in enumerate(best)])) for distance, departed in
                         ((d, dict(x)) for d, x in self.departures(inner.__getitem__, np.array([p[2] for p in parts])))]
            else:
                paths = self.paths(text)
                found = [(paths[0][0] - score, np.array(ids, dtype=np.int32).tobytes()) for score, ids in paths[1:]]
            if len(text) <= STORED_CHARS:
                if len(self.next_bests) >= NEXT_BESTS:
                    self.next_bests.clear()
                self.next_bests[text] = found
        return found

    def departures(self, text_of: Callable[[int], str], gaps: np.ndarray) -> list[tuple[float, tuple]]:
        """The next bests of a row of parts: how far each lies behind its best, and the numbers and
        ids of the parts that differ. `gaps`: how far each part's second best lies behind.

        They depart from the best in the n - 1 parts with the nearest second bests only:
        any other part's departure has n - 1 better ones, and the best, before it.
        """
        sums: list[tuple[float, tuple]] = [(0.0, ())]
        near, most = np.arange(len(gaps)), self.n_best - 1
        if 0 < most < len(gaps):
            near = np.flatnonzero(gaps <= np.partition(gaps, most - 1)[most - 1])
        for k in near[np.argsort(gaps[near], kind="stable")][:most].tolist():
            if gaps[k] < float("inf"):
                own = [(0.0, ()), *((b, ((k, ids),)) for b, ids in self.others(text_of(k)))]
                sums = sorted(((a + b, x + y) for a, x in sums for b, y in own), key=itemgetter(0))[:self.n_best]
        return sums[1:]

    def best_paths(self, text: str) -> tuple[list[bytes], list[float], bool]:
        """ids as bytes and scores of the n best segmentations, and whether decoding the ids
        of each gives the text back."""
        [(paths, scores)] = self.n_bests_of([text])
        return paths, scores, self.spelled([text], [paths])[0]

    def parts_of(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The parts of all texts, each behind a space, cut wherever no piece can cross, and how
        many each text has."""
        joined = "".join([" " + t for t in texts])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts])
        number = self.number[codes].astype(np.int64)
        pair = number[:-1] * self.base + number[1:]
        cut = np.ones(len(codes), dtype=bool)
        cut[1:] = self.bits[pair >> 3] >> (pair & 7).astype(np.uint8) & 1 == 0
        cut[ends[:-1]] = True
        at = np.flatnonzero(cut)
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.append(0, np.cumsum(width, dtype=np.int64))
        offsets = place[np.append(at, len(codes))]
        parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
        return parts.dictionary_encode(), np.diff(np.searchsorted(at, np.append(0, ends)))

    def n_bests_of(self, texts: list[str]) -> list[tuple[list[bytes], list[float]]]:
        """ids as bytes and scores of the n best segmentations of each text."""
        self.prepare()
        given = [t for t in texts if t]
        if not given:
            return [([b""], [0.0]) for _ in texts]
        coded, counts = self.parts_of(given)
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.learn(distinct)
        part, known = self.part, self.store.get
        packed, score, gap = zip(*[known(x) or part(x) for x in distinct])
        # the ids of all parts in the order of the texts
        size = np.array([len(x) // 4 for x in packed])
        n, from_ = size[at], (np.cumsum(size) - size)[at]
        ends = np.cumsum(n)
        every = np.frombuffer(b"".join(packed), dtype=np.int32)[np.repeat(from_ - ends + n, n) + np.arange(n.sum())]
        score, gap, begin, end = np.array(score)[at], np.array(gap)[at], (ends - n) * 4, ends * 4
        out, start, counts = [], 0, iter(counts.tolist())
        for t in texts:
            if not t:
                out.append(([b""], [0.0]))
                continue
            own = slice(start, start := start + next(counts))
            first = int(begin[own.start])
            whole = every[first // 4:int(end[own.stop - 1]) // 4].tobytes()
            best = float(score[own].sum())
            paths, scores = [whole], [best]
            for distance, departed in self.departures(lambda k, s=own.start: distinct[at[s + k]], gap[own]):
                parts, last = [], 0
                for k, ids in sorted(departed):
                    parts += [whole[last:int(begin[own.start + k]) - first], ids]
                    last = int(end[own.start + k]) - first
                paths.append(b"".join([*parts, whole[last:]]))
                scores.append(best - distance)
            out.append((paths, scores))
        return out

    def spelled(self, texts: list[str], paths: list[list[bytes]]) -> list[bool]:
        """Whether decoding the ids of each path of a text gives the text back."""
        table = pa.array(self.bytes_of, pa.large_binary())
        return [all(_joined(table, np.frombuffer(x, dtype=np.int32)) == raw for x in found)
                for found, raw in zip(paths, ((" " + t).encode() if t else b"" for t in texts))]

    def encode(self, text: str) -> tuple[bytes, list[float], bool]:
        """ids of the best segmentation as bytes, the scores of the n best, and whether
        decoding gives the text back."""
        paths, scores, exact = self.best_paths(text)
        return paths[0], scores, exact

    def decode(self, ids) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, rows: list) -> list[str | None]:
        """The texts of rows of ids; null for null."""
        self.prepare()
        table = pa.array(self.bytes_of, pa.large_binary())
        return [None if ids is None else bytes(_joined(table, np.asarray(ids, dtype=np.int64))).decode("utf-8", "replace")[1:]
                for ids in rows]


def _joined(table: pa.Array, ids: np.ndarray) -> pa.Buffer | bytes:
    """The bytes of a row of pieces, which lie one behind the other once they are looked up."""
    return (table.take(pa.array(ids)).buffers()[2] if len(ids) else None) or b""


def _runs(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Where runs of about `most` in all begin and end."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    bounds = [0, *cuts.tolist(), len(sizes)]
    return list(zip(bounds, bounds[1:]))


class _Steps:
    """The steps of a trie as a hash table: from a node by a character to id, score and node."""

    def __init__(self, trie: dict):
        keys, piece, score, child, nodes = [], [], [], [], [trie]
        for number, node in enumerate(nodes):  # grows meanwhile
            for character, (below, i, x) in node.items():
                keys.append(number << 21 | ord(character))
                piece.append(i)
                score.append(x)
                child.append(len(nodes) if below else -1)
                if below:
                    nodes.append(below)
        self.piece, self.child = np.array(piece, dtype=np.int64), np.array(child, dtype=np.int64)
        self.score = np.array(score, dtype=np.float64)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.row = np.full(1 << self.bits, -1), np.zeros(1 << self.bits, dtype=np.int64)
        keys = np.array(keys, dtype=np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # who finds its slot free takes it, the last of several; the others go on to the next
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]], self.row[slot[free]] = keys[free], free
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, node: np.ndarray | int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which steps there are, and the rows of these."""
        keys = np.asarray(node) << 21 | codes
        slot = self._slot(keys)
        met = self.keys[slot]
        while len(other := np.flatnonzero((met != keys) & (met >= 0))):
            slot[other] = (slot[other] + 1) & (1 << self.bits) - 1
            met[other] = self.keys[slot[other]]
        found = np.flatnonzero(met >= 0)
        return found, self.row[slot[found]]


def _packed(node: dict) -> dict[str, tuple]:
    """A trie with one look-up for a character: what follows or None, and id (or -1) and score."""
    return {c: (_packed(x) or None, *x.get("", (-1, 0.0))) for c, x in node.items() if c}


def encoded(docs: DataFrame, model: Pieces | None = None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`docs` with ids of the best segmentation, their number, the scores and ids of the n
    best, and whether decoding the ids of each gives the text back.

    `carry`: the columns of `docs` that come along; all, if not given.
    """
    model = model or Pieces.load()
    keep = carried(docs if carry is None else docs.select(*[quoted(c) for c in carry]), DERIVED)
    rows = docs.select(F.struct(F.lit(1).alias("__"), *[F.col(quoted(c)) for c in keep]).alias("row"), F.col(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own(model)
        collects = gc.isenabled()
        gc.disable()  # nothing here refers to itself, and a pass over the store's many tuples takes long
        try:
            for batch in batches:
                size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
                for start, stop in _runs(size.astype(np.int64), SLICE_BYTES):
                    yield _segmented(own, batch.slice(start, stop - start))
        finally:
            if collects:
                gc.enable()

    schema = T.StructType([
        rows.schema["row"], T.StructField("n_pieces", T.LongType()),
        T.StructField("score", T.DoubleType()), T.StructField("best_scores", T.ArrayType(T.DoubleType())),
        T.StructField("best_ids", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("exact", T.BooleanType()),
    ])
    first = F.get("best_ids", F.lit(0)).alias("ids")
    return rows.mapInArrow(run, schema).select("row.*", first, *DERIVED[1:]).drop("__")


def _segmented(own: Pieces, part: pa.RecordBatch) -> pa.RecordBatch:
    """row and the derived columns, without the ids of the best path, which lie in `best_ids`."""
    texts = part.column("text").to_pylist()
    missing = np.array([t is None for t in texts])
    given = [t for t in texts if t is not None]
    found = own.n_bests_of(given)
    same = own.spelled(given, [paths for paths, _ in found])
    each = iter(zip(found, same))
    rows = [(((), None), True) if t is None else next(each) for t in texts]
    paths, bests, exact = [p for (p, _), _ in rows], [b for (_, b), _ in rows], [e for _, e in rows]
    counts = np.array([len(p[0]) // 4 if p else 0 for p in paths], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int32)
    every = pa.ListArray.from_arrays(pa.array(offsets), _lists([x for p in paths for x in p]), mask=pa.array(missing))
    return pa.RecordBatch.from_arrays(
        [part.column("row"), pa.array(counts, mask=missing), pa.array([b and b[0] for b in bests], pa.float64()),
         pa.array(bests, pa.list_(pa.float64())), every, pa.array(exact)],
        names=["row", *DERIVED[1:]],
    )


def _lists(packed: list[bytes]) -> pa.ListArray:
    """Packed ids as lists."""
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


_models: dict[tuple, Pieces] = {}


def _own(model: Pieces) -> Pieces:
    """The process's own copy, so that its store outlives a task."""
    key = (len(model.pieces), hash(tuple(model.pieces)), hash(tuple(model.scores)), model.n_best)
    if key not in _models:
        _models.clear()
        _models[key] = model
    return _models[key]


def decoded(rows: DataFrame, model: Pieces | None = None, ids: str = "ids") -> DataFrame:
    """`rows` with the text of their ids; null for null, replaced where clashing."""
    model = model or Pieces.load()
    keep = carried(rows, ["text"])
    source = rows.select(F.struct(F.lit(1).alias("__"), *[F.col(quoted(c)) for c in keep]).alias("row"), F.col(quoted(ids)).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own(model)
        for batch in batches:
            texts = own.decode_all([x.as_py() for x in batch.column("ids")])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    schema = T.StructType([source.schema["row"], T.StructField("text", T.StringType())])
    return source.mapInArrow(run, schema).select("row.*", "text").drop("__")
