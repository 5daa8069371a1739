"""SentencePiece encoding and decoding of the merge type, with seeded merge-dropout.

A text is cut where no piece can cross: before a run of space marks that follows other characters, between characters that
no piece brings together, and around those in no longer piece. Each segment starts as single characters; the agenda holds its neighbouring pairs that form a
piece, best score first and the leftmost of equals. A candidate taken from the agenda is skipped for good when a keyed
hash of the seed, the document's id, the segment's place in the document, and the candidate's place says so. So every occurrence of
a word is segmented in its own way, the same way in every run. Without dropout the ids are those of the library.

What is remembered does not depend on the key: for a segment, a tree of its candidates in the order they are taken, each with what
follows if it is merged and if it is skipped. The hashes of an occurrence lead to a leaf, which holds the ids.

Decoding gives back the text: what has no piece is written as bytes, and the space mark itself, which a
piece cannot tell from a space, always is.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import U64, Numbers, mix, spread

MARK = "▁"
#: Share of merge candidates that are skipped, and the key of the hash.
DROPOUT = 0.1
SEED = 23
#: Words, segments, and nodes of their trees that a worker remembers; a forgotten one is worked out again, with the same result.
REMEMBERED = 100_000
NODES = 1 << 18
#: A tree grows where so many occurrences among the texts at hand need it; others are merged by themselves, with the same result.
OFTEN = 4

#: A segment of so many characters at most is merged along with others, a longer one by itself.
SHORT = 64
#: Segments merged together; texts, and characters unless it is one text, whose ids are held at a time.
RUN = 8192
ROWS = 512
CHARS = 1 << 20
NEVER = np.iinfo(np.int64).max
#: Stands for a space mark of the text itself while spaces are marks.
HELD = "\ufffe"


def place_hash(key: np.ndarray, start: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a merge candidate: where its left part begins in the segment, and the lengths of both parts."""
    return mix(key ^ ((start << 42) | (left << 21) | right).astype(U64))


class Pieces:
    """The pieces of a model file with scores; the file is read through the library and not copied."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        texts = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i) for i in range(n)]
        self.ids = {t: i for i, t in enumerate(texts) if not special[i]}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not lib.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model has no byte pieces, so not every text can be written")
        if any(MARK in t.lstrip(MARK) for t in self.ids):
            raise ValueError("a piece has a space mark after other characters, so texts cannot be cut into segments")
        self.spelled = [t.replace(MARK, " ").encode() for t in texts]
        for b, i in enumerate(self.byte_ids):
            self.spelled[i] = bytes([b])
        self.size = np.array([len(x) for x in self.spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.spelled), np.uint8)
        joined = {c for t in self.ids if len(t) > 1 for c in t}
        # A segment is space marks and the characters after them up to the next mark, cut where characters are of sets that
        # no piece brings together; or one character that is in no longer piece.
        sets = "|".join(f"{MARK}*[{re.escape(x)}]+" for x in self._together())
        self.cut = re.compile(f"{sets}|{MARK}+|." if sets else ".", re.DOTALL)
        self._pairs(lib, joined)

    def _together(self) -> list[str]:
        """Sets of characters that stand side by side in pieces, directly or through others; largest first."""
        of: dict[str, set[str]] = {}
        for t in self.ids:
            t = t.lstrip(MARK)
            if len(t) > 1 or len(t) == 1 and MARK + t in self.ids:
                own = set(t).union(*(of[c] for c in t if c in of))
                of.update(dict.fromkeys(own, own))
        return sorted({"".join(sorted(x)) for x in of.values()}, key=lambda x: (-len(x), x))

    def _pairs(self, lib, joined: set[str]) -> None:
        """Every way to split a piece into two symbols, by a code of the two; ranks put the best score first."""
        names = sorted(joined | set(self.ids))
        self.names, symbol = names, {t: i for i, t in enumerate(names)}
        self.many = len(names)
        longer = [t for t in self.ids if len(t) > 1]
        order = {x: r for r, x in enumerate(sorted({-lib.get_score(self.ids[t]) for t in longer}))}
        found = [
            (symbol[t[:k]] * self.many + symbol[t[k:]], order[-lib.get_score(self.ids[t])], symbol[t])
            for t in longer for k in range(1, len(t)) if t[:k] in symbol and t[k:] in symbol
        ]
        found.sort()
        self.codes, self.rank, self.whole = (np.array(c, np.int64) for c in zip(*found))
        self.place = Numbers(len(found))
        self.place.put(self.codes.view(U64), np.arange(len(found), dtype=np.int32))
        self.merges = {code: (rank, whole) for code, rank, whole in found}
        self.lengths = np.array([len(t) for t in names], np.int64)
        self.written = [self.spell(t) for t in names]
        self.id_of = np.array([self.ids.get(t, -1) for t in names], np.int64)
        self.of_char = np.full(0x110000, -1, np.int64)
        for t, i in symbol.items():
            if len(t) == 1:
                self.of_char[ord(t)] = i

    def segments(self, text: str) -> list[str]:
        """The segments of a text; joined they are the text with spaces as marks and one mark in front."""
        return self.cut.findall(MARK + text.replace(MARK, HELD).replace(" ", MARK)) if text else []

    def spell(self, part: str) -> bytes:
        """Ids of one part, its own or those of its bytes, as 4-byte numbers: in this form they are kept and joined."""
        known = self.ids.get(part)
        return np.array([known] if known is not None else [self.byte_ids[b] for b in part.replace(HELD, MARK).encode("utf-8", "surrogatepass")], np.int32).tobytes()

    def _ranked(self, a: np.ndarray, b: np.ndarray, start: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the merge of each pair; ``NEVER`` where there is none or it is skipped."""
        code = np.where((a >= 0) & (b >= 0), a * self.many + b, -1)
        at = self.place.get(code.view(U64))
        rank = np.where(at >= 0, self.rank[at], NEVER)
        if limit:
            hit = np.flatnonzero(rank < NEVER)
            skip = place_hash(keys[hit], start[hit], self.lengths[a[hit]], self.lengths[b[hit]]) < U64(limit)
            rank[hit[skip]] = NEVER
        return rank, self.whole[at]

    def merge_many(self, segments: list[str], keys: np.ndarray, limit: int) -> list[bytes]:
        """Ids of many segments at once. Each round takes the first candidate from the agenda of every segment that has one."""
        lengths = np.array([len(s) for s in segments], np.int64)
        out: list = [None] * len(segments)
        low = 1
        for high in (1, 6, 10, 16, 28, SHORT):
            rows = np.flatnonzero((lengths >= low) & (lengths <= high))
            low = high + 1
            for at in range(0, len(rows), RUN):
                some = rows[at : at + RUN]
                own = [segments[i] for i in some]
                made = self._merge_block(own, lengths[some], keys[some], limit) if high > 1 else map(self.spell, own)
                for i, x in zip(some.tolist(), made, strict=True):
                    out[i] = x
        for i in np.flatnonzero(lengths > SHORT):
            out[i] = b"".join(map(self.spell, self._merge_long(segments[i], keys[i : i + 1], limit)))
        return out

    def _merge_block(self, segments: list[str], lengths: np.ndarray, keys: np.ndarray, limit: int) -> list[bytes]:
        """Segments of more than one character, side by side. A part stays in the place of its first character; ``right``
        and ``left`` name its neighbours' places, and ``rank`` is the agenda: the rank of each part with its right neighbour."""
        n, width = len(segments), int(lengths.max()) + 1
        chars = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        row, place = np.repeat(np.arange(n), lengths), np.arange(len(chars)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        symbols = np.full(n * width, -1, np.int64)
        symbols[row * width + place] = self.of_char[chars]
        where = np.tile(np.arange(width), n)
        right, left = where + 1, where - 1
        rank, whole = self._ranked(symbols, np.append(symbols[1:], -1), where, np.repeat(keys, width), limit)
        agenda = rank.reshape(n, width)
        alive = np.arange(n)
        while True:
            best = agenda[alive].argmin(axis=1)
            alive, best = (x[rank[alive * width + best] < NEVER] for x in (alive, best))
            if not len(alive):
                break
            base = alive * width
            i, j = base + best, base + right[base + best]
            symbols[i], symbols[j], rank[j] = whole[i], -1, NEVER
            after, before = right[j], left[i]
            right[i] = after
            left[(base + after)[after < width]] = best[after < width]
            # The merged part with its right neighbour (the last place of a row is empty, so there is one), and with its left.
            rank[i], whole[i] = self._ranked(symbols[i], symbols[base + np.minimum(after, width - 1)], best, keys[alive], limit)
            ok = before >= 0
            k = (base + before)[ok]
            rank[k], whole[k] = self._ranked(symbols[k], symbols[i[ok]], before[ok], keys[alive[ok]], limit)
        full = symbols >= 0
        cuts = np.concatenate([[0], np.cumsum(full.reshape(n, width).sum(axis=1))])
        ids = self.id_of[symbols[full]]
        packed, cuts4 = ids.astype(np.int32).tobytes(), (cuts * 4).tolist()
        out = [packed[a:b] for a, b in zip(cuts4[:-1], cuts4[1:], strict=True)]
        for r in np.unique(np.searchsorted(cuts, np.flatnonzero(ids < 0), side="right") - 1):  # a character without a piece of its own
            out[r] = b"".join(map(self.written.__getitem__, symbols[full][cuts[r] : cuts[r + 1]].tolist()))
        return out

    def _merge_long(self, segment: str, key: np.ndarray, limit: int) -> list[str]:
        """The same with a heap, for a segment of any length."""
        n = len(segment)
        parts, right, left = list(segment), list(range(1, n + 1)), list(range(-1, n - 1))
        symbol = self.of_char[[ord(c) for c in segment]].tolist()
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(places: list[int]) -> None:
            at = np.array([a for a in places if a >= 0 and right[a] < n], np.int64)
            if len(at):
                a, b = np.array([symbol[i] for i in at]), np.array([symbol[right[i]] for i in at])
                for i, r, w in zip(at.tolist(), *(x.tolist() for x in self._ranked(a, b, at, np.repeat(key, len(at)), limit)), strict=True):
                    if r < NEVER:
                        heapq.heappush(agenda, (r, i, len(parts[i]), len(parts[right[i]]), w))

        offer(list(range(n - 1)))
        while agenda:
            _, a, la, lb, w = heapq.heappop(agenda)
            b = right[a]
            if len(parts[a]) != la or b >= n or len(parts[b]) != lb:
                continue  # one of the two has been merged meanwhile
            parts[a] += parts[b]
            parts[b], symbol[a] = "", w
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
            offer([left[a], a])
        return [p for p in parts if p]

    def decode(self, ids) -> str:
        """The text of ids as ``Encoder`` makes them."""
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]  # without the mark in front


    def decodes_to(self, ids: list[np.ndarray], texts: list[str]) -> list[bool]:
        """Whether ids decode to their texts, for a run of documents: one gather from the flat table of spelled bytes."""
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        every = np.concatenate([np.zeros(0, np.int32), *ids])
        sizes = self.size[every]
        data = self.flat[np.repeat(self.start[every], sizes) + spread(sizes)].tobytes()
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(counts)].tolist()
        return [data[min(a + 1, b) : b] == t.encode("utf-8", "surrogatepass") for a, b, t in zip([0, *ends], ends, texts)]  # without the mark in front


class Trees:
    """Per segment what its merge candidates lead to, as far as occurrences have needed it.

    A node is the next candidate of the agenda (``place``) or a leaf (``leaf``: where in ``ids``); ``child`` holds the nodes that
    follow a merge (even) and a skip (odd), or -1 for one not worked out yet.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.n, self.ids = pieces, 0, []
        self.place, self.leaf = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.child, self.above = np.full(2048, -1, np.int32), []

    def _node(self, above: int, place: int, leaf: int) -> int:
        """A new node; ``above`` is the slot of ``child`` it belongs to, or -1 for a root."""
        if self.n == len(self.place):
            self.place, self.leaf = (np.concatenate([x, np.zeros_like(x)]) for x in (self.place, self.leaf))
            self.child = np.concatenate([self.child, np.full_like(self.child, -1)])
        at, self.n = self.n, self.n + 1
        self.place[at], self.leaf[at] = place, leaf
        self.above.append(above)
        if above >= 0:
            self.child[above] = at
        return at

    def grow(self, segment: str, slot: int) -> int:
        """Add what follows a slot without a node (-1: the root), up to the leaf where no more is skipped; the first new node."""
        skips, at = [], slot
        while at >= 0:
            skips.append(at & 1)
            at = self.above[at >> 1]
        first = -1
        for place, ids in self._taken(segment, skips[::-1]):
            if ids is not None:
                self.ids.append(ids)
            node = self._node(slot, place, -1 if ids is None else len(self.ids) - 1)
            first, slot = node if first < 0 else first, 2 * node
        return first

    def _taken(self, segment: str, skips: list[int]) -> Iterator[tuple[int, bytes | None]]:
        """The candidates after those that ``skips`` decides, all merged, and at the end the ids."""
        p, n = self.pieces, len(segment)
        symbol, lengths = p.of_char[[ord(c) for c in segment]].tolist(), [1] * n
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and symbol[i] >= 0 and symbol[j] >= 0:
                found = p.merges.get(symbol[i] * p.many + symbol[j])
                if found is not None:
                    heapq.heappush(agenda, (found[0], i, lengths[i], lengths[j], found[1]))

        for i in range(n - 1):
            offer(i)
        done = 0
        while agenda:
            _, a, la, lb, whole = heapq.heappop(agenda)
            b = right[a]
            if lengths[a] != la or b >= n or lengths[b] != lb:
                continue  # one of the two has been merged meanwhile
            if done >= len(skips):
                yield (a << 42) | (la << 21) | lb, None
            done += 1
            if done <= len(skips) and skips[done - 1]:
                continue
            lengths[a], lengths[b], symbol[a], right[a] = la + lb, 0, whole, right[b]
            if right[b] < n:
                left[right[b]] = a
            if left[a] >= 0:
                offer(left[a])
            offer(a)
        yield 0, b"".join(p.spell(segment[i : i + k]) for i, k in enumerate(lengths) if k)


class Encoder:
    """Encodes texts, remembering the segments of words and the trees of segments."""

    def __init__(self, pieces: Pieces, dropout: float = DROPOUT, seed: int = SEED) -> None:
        self.pieces, self.seed = pieces, seed
        self.limit = min(int(min(max(dropout, 0.0), 1.0) * 2**64), 2**64 - 1)
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, bytes] = {}
        self.numbers: dict[str, int] = {}
        self.segments: list[str] = []
        self.roots = np.zeros(0, np.int32)
        self.trees = Trees(self.pieces)

    def encode(self, text: str, doc: int = 0) -> np.ndarray:
        return self.encode_many([text], [doc])[0]

    def encode_many(self, texts: list[str], docs: list[int]) -> list[np.ndarray]:
        """Ids of texts, each of the document with the given id. All occurrences of segments in all texts are led to their ids together."""
        if len(self.words) > REMEMBERED or len(self.segments) > REMEMBERED or self.trees.n > NODES:
            self._forget()
        split = [None if HELD in t else t.split(" ") if t else [] for t in texts]
        # A text with a mark of its own, or with spaces in a row, in front or at the end is cut as a whole.
        whole = {i: self.pieces.segments(texts[i]) for i, x in enumerate(split) if x and ("" in x or MARK in texts[i])}
        plain = [i for i, x in enumerate(split) if x and i not in whole]
        find, words = self.pieces.cut.findall, self.words
        for w in set().union(*(split[i] for i in plain)).difference(words):
            words[w] = self._numbered(find(MARK + w))
        own = [b""] * len(texts)
        for i in plain:
            own[i] = b"".join(map(words.__getitem__, split[i]))
        for i, parts in whole.items():
            own[i] = self._numbered(parts)
        counts = np.array([len(x) // 4 for x in own], np.int64)
        at = np.cumsum(counts) - counts
        place = np.arange(counts.sum()) - np.repeat(at, counts)
        docs_hash = mix(np.array(docs, np.int64).view(U64) ^ mix(np.array([self.seed], np.int64).view(U64)))
        keys = mix(np.repeat(docs_hash, counts) + place.astype(U64))
        which, ids = self._led(np.frombuffer(b"".join(own), np.int32), keys)
        which = which.tolist()
        out = []
        for t, x, a, n in zip(texts, split, at.tolist(), counts.tolist(), strict=True):
            if x is None:  # HELD stands for the mark inside this module, so such a text is written as bytes
                out.append(np.array([self.pieces.ids[MARK], *(self.pieces.byte_ids[b] for b in t.encode("utf-8", "surrogatepass"))], np.int32))
            else:
                out.append(np.frombuffer(b"".join(map(ids.__getitem__, which[a : a + n])), np.int32))
        return out

    def _numbered(self, parts: list[str]) -> bytes:
        """Segments as numbers of 4 bytes, new ones added."""
        numbers = self.numbers
        for x in parts:
            if x not in numbers:
                numbers[x] = len(numbers)
                self.segments.append(x)
        return array("i", map(numbers.__getitem__, parts)).tobytes()

    def _led(self, numbers: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """For each occurrence of a segment where in a list its ids are, and the list."""
        trees, limit = self.trees, U64(self.limit)
        self.roots = np.concatenate([self.roots, np.full(len(self.segments) - len(self.roots), -1, np.int32)])
        which = np.full(len(numbers), -1, np.int64)
        alone = [np.zeros(0, np.int64)]
        rows, slots, nodes = np.arange(len(numbers)), np.full(len(numbers), -1), self.roots[numbers]
        while len(rows):
            missing = nodes < 0
            if missing.any():
                lost, slot, own = rows[missing], slots[missing], numbers[rows[missing]]
                _, first, of, count = np.unique((slot + 1) * len(self.segments) + own, return_index=True, return_inverse=True, return_counts=True)
                new = np.full(len(first), -1, np.int64)
                for k in np.flatnonzero(count >= OFTEN):
                    segment, above = self.segments[own[first[k]]], int(slot[first[k]])
                    if len(segment) <= SHORT:
                        new[k] = trees.grow(segment, above)
                        if above < 0:
                            self.roots[own[first[k]]] = new[k]
                nodes = nodes.astype(np.int64)
                nodes[missing] = new[of]
                alone.append(lost[new[of] < 0])
                rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
            ends = trees.leaf[nodes]
            which[rows[ends >= 0]] = ends[ends >= 0]
            rows, nodes = rows[ends < 0], nodes[ends < 0]
            slots = 2 * nodes + (mix(keys[rows] ^ trees.place[nodes].view(U64)) < limit)
            nodes = trees.child[slots]
        left = np.concatenate(alone)
        which[left] = len(trees.ids) + np.arange(len(left))
        return which, trees.ids + self.pieces.merge_many([self.segments[i] for i in numbers[left].tolist()], keys[left], self.limit)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(model: bytes, dropout: float, seed: int) -> Encoder:
    """The encoder of this process; a worker that runs several tasks keeps what it remembers."""
    key = (hashlib.sha256(model).hexdigest(), dropout, seed)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Pieces(model), dropout, seed)
    return _ENCODERS[key]


def _encode_batch(batch: pa.RecordBatch, enc: Encoder) -> Iterator[tuple[pa.Array, list[str], list[np.ndarray]]]:
    """(ids of documents, texts, ids of tokens) of a few rows at a time; a null id counts as 0."""
    all_texts = [t or "" for t in batch.column(1).to_pylist()]
    at = 0
    while at < batch.num_rows:
        to, held = at + 1, len(all_texts[at])
        while to < min(at + ROWS, batch.num_rows) and held + len(all_texts[to]) <= CHARS:
            held += len(all_texts[to])
            to += 1
        own, texts = batch.column(0).slice(at, to - at), all_texts[at:to]
        yield own, texts, enc.encode_many(texts, own.fill_null(0).to_pylist())
        at = to


def read_model(path: str) -> bytes:
    """The model file at a path on the driver: under a megabyte, sent along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED, check: bool = False) -> DataFrame:
    """(doc_id, ids, n_tokens) of every whole text of ``docs`` (doc_id, text); with ``check`` also lossless, telling whether
    the decoded ids are the text.

    A null or empty text has no ids; a null id is allowed and counts as 0 in the key of the hash. Equal rows give equal
    ids; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    names = ["doc_id", "ids", "n_tokens", *["lossless"] * check]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, dropout, seed)
        for batch in batches:
            for own, texts, ids in _encode_batch(batch, enc):
                columns = [own, pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())]
                if check:
                    columns.append(pa.array(enc.pieces.decodes_to(ids, texts), pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names)

    types = "doc_id long, ids array<int>, n_tokens long" + ", lossless boolean" * check
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, types)


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the texts that were encoded. Null or no ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(shared.value, 0.0, 0).pieces
        for batch in batches:
            texts = [pieces.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


ROUND_TRIP = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_byte_tokens", pa.int64()), ("ids_sha256", pa.string()), ("lossless", pa.bool_())])


def round_trips(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Encode and decode every text in one pass: doc_id, n_tokens, n_byte_tokens, ids_sha256 (of the ids as 4-byte
    little-endian numbers) and lossless (the decoded ids are the text). Edge cases are those of ``encoded``."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, dropout, seed)
        first, last = enc.pieces.byte_ids[0], enc.pieces.byte_ids[255]
        for batch in batches:
            for own, texts, found in _encode_batch(batch, enc):
                columns = [
                    own, [len(x) for x in found], [int(((x >= first) & (x <= last)).sum()) for x in found],
                    [hashlib.sha256(x.tobytes()).hexdigest() for x in found], enc.pieces.decodes_to(found, texts),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROUND_TRIP)], schema=ROUND_TRIP)

    types = "doc_id long, n_tokens long, n_byte_tokens long, ids_sha256 string, lossless boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, types)
