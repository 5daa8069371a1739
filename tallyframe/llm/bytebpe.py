"""Byte-level BPE: vectorised cutting of text, cached merging of pairs, and decoding by offsets.

**Cutting.** Text is cut as the pattern of the rank files cuts it: an apostrophe with one of s t re ve m ll d, or letters,
digits or other characters with at most one blank before them, or white space, whose last character goes to what
follows. No regular expression is used. Every code point has a class; a class is a function from the state before the
character to the state after it; and functions compose, so the states of a whole run of texts come from a scan:
blocks of characters are composed side by side, the blocks' functions are scanned, and each block is gone through from the
state that reaches it. Only apostrophes make the state matter: one inside a run of other characters opens no ending.
Documents of a run are set apart by a character of their own, whose function leads to the start from every state.

**Merging.** A piece of text is looked up whole among the ranks. If it is none, its bytes are merged pair by pair, the lowest
rank first and of equal ones the leftmost. Equal pieces of a run are merged once, and a worker remembers short ones.

**Decoding.** Every token keeps the byte offset at which it ends in its document, so decoding is one gather of the tokens' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import RUN_BYTES, U64, Numbers, Rolling, mix, spread, text_runs

# Classes of characters. An apostrophe that the ending of a word follows is told from others by its two classes.
LETTER, DIGIT, OTHER, BLANK, SPACE, ENDING_2, ENDING_3, BREAK = range(8)
# States after a character: nothing open, a run of letters, digits or others, white space that ends in a blank or not, and
# one or two letters of an ending to come.
START, LETTERS, DIGITS, OTHERS, AFTER_BLANK, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)
N_STATES = 8

# White space of the Unicode standard (property White_Space).
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Endings that an apostrophe opens.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")

#: The code point that stands between documents of a run.
BETWEEN = 0x110000
#: Functions of four characters are composed in blocks of so many.
BLOCK = 32
#: Pieces of up to so many bytes are merged side by side and remembered; a worker forgets them when there are so many.
SHORT_BYTES, REMEMBERED = 40, 400_000

#: Digests are made from so many ids at a time.
RUN_IDS = 1 << 15

ENCODED = "doc_id long, ids array<int>, ends array<long>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(BETWEEN)), np.uint8, BETWEEN)
    table[list(WHITE_SPACE)] = SPACE
    table[0x20] = BLANK
    return np.append(table, np.uint8(BREAK))


def _next_state(kind: int, state: int) -> int:
    """The state after a character of a class. An ending's letters are letters of no run: they count down."""
    if kind == BREAK:
        return START
    if kind == BLANK:
        return AFTER_BLANK
    if kind == SPACE:
        return AFTER_SPACE
    if state == TWO_MORE:
        return ONE_MORE
    if state == ONE_MORE:
        return START
    if kind in (ENDING_2, ENDING_3):
        # Among other characters, and after a blank that joins them, an apostrophe is one of them.
        if state in (OTHERS, AFTER_BLANK):
            return OTHERS
        return ONE_MORE if kind == ENDING_2 else TWO_MORE
    return {LETTER: LETTERS, DIGIT: DIGITS, OTHER: OTHERS}[kind]


#: The function of each class: the state after it for every state before it.
STEP = np.array([[_next_state(kind, state) for state in range(N_STATES)] for kind in range(8)], np.uint8)

#: Whether a piece starts at a character that is no white space, by the states before and after it.
STARTS = np.ones((N_STATES, N_STATES), bool)
for _open in (LETTERS, DIGITS, OTHERS):
    STARTS[_open, _open] = False
STARTS[AFTER_BLANK, [LETTERS, DIGITS, OTHERS]] = False
STARTS[[ONE_MORE, TWO_MORE], :] = False


def _composed(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The functions of all pairs of two lists of functions, one after the other."""
    return then[np.arange(len(then))[None, :, None], first[:, None, :]].reshape(-1, N_STATES)


#: The functions of any four classes in a row, from the class of the first at the highest place.
STEP_4 = _composed(_composed(STEP, STEP), _composed(STEP, STEP)).ravel()


def scan(kinds: np.ndarray) -> np.ndarray:
    """The state after every character, from START: an associative scan of the classes' functions.

    A function is a row of states. The functions of four characters in a row are looked up; blocks of these are composed column by
    column, all blocks at once; the composed blocks are themselves scanned; then every block is gone through from the state that
    reaches it, and the characters between are filled in.
    """
    n = len(kinds)
    blocks = -(-n // (4 * BLOCK))
    padded = np.full(blocks * 4 * BLOCK, BREAK, np.uint8)
    padded[:n] = kinds
    by_four = padded.reshape(-1, 4).astype(np.int32)
    codes = ((by_four[:, 0] * 8 + by_four[:, 1]) * 8 + by_four[:, 2]) * 8 + by_four[:, 3]
    columns = np.ascontiguousarray(codes.reshape(blocks, BLOCK).T) * N_STATES
    whole = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (blocks, N_STATES))
    for column in columns:
        whole = STEP_4[column[:, None] + whole]
    state = np.empty(blocks, np.uint8)
    state[:1] = START
    state[1:] = _compose_along(whole[:-1])[:, START]
    reached = np.empty((BLOCK, blocks), np.uint8)
    for i, column in enumerate(columns):
        reached[i] = state
        state = STEP_4[column + state]
    out = np.empty((blocks * BLOCK, 4), np.uint8)
    now, flat = reached.T.reshape(-1), STEP.ravel()
    for k in range(4):
        out[:, k] = now = flat[by_four[:, k] * N_STATES + now]
    return out.reshape(-1)[:n]


def _compose_along(functions: np.ndarray) -> np.ndarray:
    """All prefixes of a list of functions, composed in doubling steps."""
    out, reach = functions.copy(), 1
    while reach < len(out):
        out[reach:] = np.take_along_axis(out[reach:], out[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a run of texts with ``BETWEEN`` after each text, and the bytes that each takes (0 for ``BETWEEN``).

    A byte that is no UTF-8 counts as a character of its own, neither letter nor digit nor white space.
    """
    if len(data) == 0 or data.max() < 0x80:
        points = data.astype(np.int32)
        size = np.ones(len(data), np.int64)
        at = offsets[1:]
    else:
        raw = data.tobytes()
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        try:
            if ((data[inner] & 0xC0) == 0x80).any():
                raise UnicodeDecodeError("utf-8", b"", 0, 0, "a text starts inside a character")
            text = raw.decode()
        except UnicodeDecodeError:  # texts one by one, so that a broken end does not reach into the next text
            text = "".join(raw[a:b].decode(errors="surrogateescape") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)
        size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        size[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
        at = np.searchsorted(np.cumsum(size), offsets[1:], side="left") + 1
        at[offsets[1:] == 0] = 0
    return np.insert(points, at, BETWEEN), np.insert(size, at, 0)


def _marked_endings(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Classes with apostrophes that an ending follows told apart."""
    at = np.flatnonzero(points == ord("'"))
    if len(at) == 0:
        return kinds
    kinds = kinds.copy()
    # A run ends with BETWEEN, so the character behind an apostrophe is there; the one behind that may be missing.
    one = points[at + 1]
    two = points[np.minimum(at + 2, len(points) - 1)]
    for e in ENDINGS:
        fits = (one == ord(e[0])) & ((two == ord(e[1])) if len(e) == 2 else True)
        kinds[at[fits]] = ENDING_2 if len(e) == 1 else ENDING_3
    return kinds


def cuts(points: np.ndarray) -> np.ndarray:
    """Which code points start a piece of text; ``BETWEEN`` starts one of no bytes."""
    kinds = _marked_endings(points, _classes()[points])
    state = scan(kinds)
    before = np.empty(len(state), np.uint8)
    before[:1] = START
    before[1:] = state[:-1]
    starts = STARTS[before, state]
    white = (kinds == BLANK) | (kinds == SPACE)
    # White space goes with white space, but its last character stands apart if a document goes on behind it.
    was_white = np.zeros(len(white), bool)
    was_white[1:] = white[:-1]
    last = np.zeros(len(white), bool)
    last[:-1] = white[:-1] & ~white[1:] & (kinds[1:] != BREAK)
    starts[white] = ~was_white[white] | last[white]
    starts[kinds == BREAK] = True
    return starts


#: Stands for the rank of a pair that is no token.
NO_RANK = np.int32(2**31 - 1)


class Ranks:
    """The ranks of a file: spelling for decoding, and for encoding the pairs that merge and the pieces a worker remembers."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        spelled = [b""] * (max(self.rank.values(), default=-1) + 1)
        for token, rank in self.rank.items():
            spelled[rank] = token
        self.size = np.array([len(t) for t in spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    @cached_property
    def one_byte(self) -> np.ndarray:
        return np.array([self.rank[bytes([b])] for b in range(256)], np.int32)

    @cached_property
    def pairs(self) -> Numbers:
        """The rank of every two tokens that make a third."""
        rank, found = self.rank, {}
        for token, r in rank.items():
            for k in range(1, len(token)):
                a, b = rank.get(token[:k]), rank.get(token[k:])
                if a is not None and b is not None:
                    found[a << 32 | b] = r
        table = Numbers(len(found))
        table.put(np.fromiter(found, U64, len(found)), np.fromiter(found.values(), np.int32, len(found)))
        return table

    @cached_property
    def byte_pairs(self) -> np.ndarray:
        """The rank of every two bytes."""
        return self.rank_of(np.repeat(self.one_byte, 256), np.tile(self.one_byte, 256))

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.pairs.get(a.astype(U64) << U64(32) | b.astype(U64))
        return np.where(found < 0, NO_RANK, found)

    @cached_property
    def known(self) -> "Pieces":
        return Pieces(self)

    def merge_short(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many pieces of up to SHORT_BYTES bytes, merged side by side, and how many each has.

        Every round merges one pair of each piece, the leftmost of its lowest rank; pieces without such a pair are done.
        """
        width = int(length.max())
        place = np.arange(width)
        inside = place < length[:, None]
        raw = data[np.minimum(start[:, None] + place, len(data) - 1)]
        ids = np.where(inside, self.one_byte[raw], np.int32(-1))
        ranks = np.where(inside[:, 1:], self.byte_pairs[raw[:, :-1].astype(np.int32) * 256 + raw[:, 1:]], NO_RANK)
        out = np.full((len(start), width), -1, np.int32)
        rows = np.arange(len(start))
        while True:
            here = np.arange(len(rows))
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[here, at]
                done = best == NO_RANK
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                if done.all():
                    break
                on = ~done
                rows, ids, ranks, at, best = rows[on], ids[on], ranks[on], at[on], best[on]
                here = np.arange(len(rows))
            ids[here, at] = best
            cells = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cells + (cells > at[:, None]), axis=1)
            cells = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, cells + (cells >= at[:, None]), axis=1)
            left = np.flatnonzero(at > 0)
            right = np.flatnonzero(at + 1 < ids.shape[1])
            right = right[ids[right, at[right] + 1] >= 0]
            ranks[left, at[left] - 1] = self.rank_of(ids[left, at[left] - 1], ids[left, at[left]])
            tail = np.flatnonzero(at < ranks.shape[1])
            ranks[tail, at[tail]] = NO_RANK
            ranks[right, at[right]] = self.rank_of(ids[right, at[right]], ids[right, at[right] + 1])
        return out[out >= 0], (out >= 0).sum(axis=1)

    def merge_long(self, piece: bytes) -> list[int]:
        """Tokens of one piece of any length, with an agenda: parts know their neighbours, and an entry counts while its two parts are as they were."""
        rank, n = self.rank, len(piece)
        if piece in rank:
            return [rank[piece]]
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = []

        def propose(a: int, stop: int) -> None:
            r = rank.get(piece[a:stop])
            if r is not None:
                heapq.heappush(agenda, (r, a, stop))

        for i in range(n - 1):
            propose(i, i + 2)
        alive = bytearray(b"\x01") * n
        while agenda:
            _, a, stop = heapq.heappop(agenda)
            b = end[a]
            if not alive[a] or b >= n or end[b] != stop:
                continue
            end[a], alive[b] = stop, 0
            if stop < n:
                before[stop] = a
                propose(a, end[stop])
            if before[a] >= 0:
                propose(before[a], stop)
        out, at = [], 0
        while at < n:
            out.append(rank[piece[at : end[at]]])
            at = end[at]
        return out


def keys_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each piece: its bytes and their number if there are seven or fewer, else a hash of 64 bits."""
    length = end - start
    wide = np.zeros(len(data) + 8, np.uint8)
    wide[: len(data)] = data
    words = np.ndarray(len(data) + 1, "<u8", wide, strides=(1,))
    short = length < 8
    key = np.empty(len(start), U64)
    bits = (length[short] * 8).astype(U64)
    key[short] = (words[start[short]] & ((U64(1) << bits) - U64(1))) | (length[short].astype(U64) << U64(56))
    if not short.all():
        key[~short] = mix(Rolling(data).of(start[~short], end[~short]) ^ length[~short].astype(U64)) | U64(1 << 63)
    return key


class Pieces:
    """Short pieces that a worker has met, with their tokens. All whole tokens are among them: a piece that is one is not merged."""

    def __init__(self, ranks: Ranks) -> None:
        self.ranks = ranks
        whole = np.flatnonzero((ranks.size > 0) & (ranks.size <= SHORT_BYTES))
        self.whole = keys_of(ranks.bytes, ranks.start[whole], ranks.start[whole] + ranks.size[whole]), whole.astype(np.int32)
        self.forget(REMEMBERED, 4 * REMEMBERED)

    def forget(self, room: int, tokens: int) -> None:
        """Start again with whole tokens alone, and room for so many pieces of so many tokens."""
        keys, ids = self.whole
        self.table = Numbers(len(keys) + room)
        self.table.put(keys, np.arange(len(keys), dtype=np.int32))
        self.ids = np.empty(len(keys) + tokens, np.int32)
        self.ids[: len(ids)] = ids
        self.at = np.empty(len(keys) + room + 1, np.int64)
        self.at[: len(ids) + 1] = np.arange(len(ids) + 1)
        self.n = len(ids)

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among ``ids`` and number of the tokens of each piece; valid until the next call."""
        keys = keys_of(data, start, end)
        found = self.table.get(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            _, first = np.unique(keys[new], return_index=True)
            first = new[first]
            ids, count = self.ranks.merge_short(data, start[first], end[first] - start[first])
            if self.n + len(first) >= len(self.at) or self.at[self.n] + len(ids) > len(self.ids):
                keys_left = np.unique(keys)
                self.forget(max(REMEMBERED, len(keys_left)), max(4 * REMEMBERED, SHORT_BYTES * len(keys_left)))
                return self.of(data, start, end)
            base = self.at[self.n]
            self.ids[base : base + len(ids)] = ids
            self.at[self.n + 1 : self.n + 1 + len(first)] = base + np.cumsum(count)
            self.table.put(keys[first], np.arange(self.n, self.n + len(first), dtype=np.int32))
            self.n += len(first)
            found[new] = self.table.get(keys[new])
        return self.at[found], self.at[found + 1] - self.at[found]


@lru_cache(2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def encode_run(data: np.ndarray, offsets: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all tokens of a run of texts, where each ends in the run, and the place of each text's first token (one entry more than texts)."""
    points, size = code_points(data, offsets)
    starts = np.flatnonzero(cuts(points))
    place = np.append((np.cumsum(size) - size)[starts], len(data))
    start, end = place[:-1], place[1:]
    real = end > start
    start, end = start[real], end[real]
    short = end - start <= SHORT_BYTES
    at, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    at[short], count[short] = ranks.known.of(data, start[short], end[short])
    flat = ranks.known.ids
    if not short.all():  # long pieces are merged one by one, and their tokens put behind those that are remembered
        long = np.flatnonzero(~short)
        tokens = [ranks.merge_long(data[a:b].tobytes()) for a, b in zip(start[long].tolist(), end[long].tolist())]
        count[long] = [len(t) for t in tokens]
        at[long] = len(flat) + np.cumsum(count[long]) - count[long]
        flat = np.concatenate([flat, np.concatenate([np.array(t, np.int32) for t in tokens])])
    ids = flat[np.repeat(at, count) + spread(count)].astype(np.int64)
    ends = np.cumsum(ranks.size[ids])
    return ids, ends, np.searchsorted(ends, offsets, side="right")


def _segments(data: np.ndarray, most: int) -> list[int]:
    """Places that cut a long text into segments of about ``most`` bytes, each where white space follows a printable
    ASCII character: a piece starts there whatever is around it."""
    out, at = [0], most
    while at < len(data):
        window = data[at - 1 : at + most]
        fits = np.flatnonzero(((window[1:] == 0x20) | (window[1:] == 0x0A)) & (window[:-1] > 0x20) & (window[:-1] < 0x7F))
        if len(fits):
            out.append(at + int(fits[0]))
            at = out[-1] + most
        else:
            at += most
    return [*out, len(data)]


def encode_texts(data: np.ndarray, offsets: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``encode_run`` for a run of any size: a long text, which is a run of its own, is encoded in segments."""
    if len(offsets) != 2 or len(data) <= 2 * RUN_BYTES:
        return encode_run(data, offsets, ranks)
    ids, ends = [], []
    places = _segments(data, RUN_BYTES)
    for a, b in zip(places[:-1], places[1:]):
        some, at, _ = encode_run(data[a:b], np.array([0, b - a]), ranks)
        ids.append(some.astype(np.int32))
        ends.append(at + a)
    ids, ends = np.concatenate(ids), np.concatenate(ends)
    return ids, ends, np.array([0, len(ids)])


def decode_run(ids: np.ndarray, ends: np.ndarray, ranks: Ranks) -> np.ndarray:
    """The bytes of tokens, each put where its offset says."""
    size = ranks.size[ids]
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    step = spread(size)
    out[np.repeat(ends - size, size) + step] = ranks.bytes[np.repeat(ranks.start[ids], size) + step]
    return out


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    ranks = ranks_of(path)
    for batch in batches:
        for a, b, data, offsets in text_runs(batch.column(1)):
            ids, ends, at = encode_texts(data, offsets, ranks)
            own = ends - np.repeat(offsets[:-1], np.diff(at))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, t)) for v, t in ((ids, pa.int32()), (own, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *lists], ["doc_id", "ids", "ends"])


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and ends (the byte offset in the text at which each token ends) for every row of ``docs`` (doc_id, text),
    by the ranks of the file at ``path``, which every executor can read.

    A null text is an empty one and has no tokens. Rows of a null or repeated id are rows of their own, other columns are left out, and an
    empty table gives no rows. Pieces of 8 to 40 bytes are told apart by hashes of 64 bits.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda batches: _encode_batches(batches, path), ENCODED)


def _lists(column: pa.Array, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of a run of lists and the place of each list's first one; a null list is an empty one."""
    part = column.slice(a, b - a)
    sizes = np.array([0 if n is None else n for n in part.value_lengths().to_pylist()], np.int64)
    return part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(sizes))


def _digest(ids: np.ndarray, ends: np.ndarray, ranks: Ranks, decimal: list[bytes]) -> tuple[str, str]:
    """Digests of one document's ids and of its decoded bytes, some ids at a time."""
    by_ids, by_text = hashlib.sha256(), hashlib.sha256()
    for a in range(0, len(ids), RUN_IDS):
        part = ids[a : a + RUN_IDS]
        by_ids.update((b" " if a else b"") + b" ".join(map(decimal.__getitem__, part.tolist())))
        by_text.update(decode_run(part, ends[a : a + RUN_IDS] - (ends[a - 1] if a else 0), ranks))
    return by_ids.hexdigest(), by_text.hexdigest()


def _digest_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    ranks = ranks_of(path)
    decimal = [b"%d" % i for i in range(len(ranks.size))]
    for batch in batches:
        size = np.array([n or 0 for n in batch.column(1).value_lengths().to_pylist()], np.int64)
        for a, b in _runs(size, RUN_IDS):
            ids, at = _lists(batch.column(1), a, b)
            ends, _ = _lists(batch.column(2), a, b)
            both = [_digest(ids[i:j], ends[i:j], ranks, decimal) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(at)), *(pa.array(c, pa.string()) for c in zip(*both))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows cut in runs of about ``most`` values; a larger row is a run of its own."""
    so_far = np.append(0, np.cumsum(sizes))
    at = 0
    while at < len(sizes):
        to = int(np.searchsorted(so_far, so_far[at] + most, side="right")) - 1
        to = min(max(to, at + 1), len(sizes))
        yield at, to
        at = to


def digests(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by blanks) and decoded_sha256 (the bytes the ids stand for) of rows of ``encoded``."""
    return tokens.select("doc_id", "ids", "ends").mapInArrow(lambda batches: _digest_batches(batches, path), DIGESTS)


def _decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    ranks = ranks_of(path)
    for batch in batches:
        texts = []
        for i in range(batch.num_rows):
            (ids, _), (ends, _) = _lists(batch.column(1), i, i + 1), _lists(batch.column(2), i, i + 1)
            texts.append(decode_run(ids, ends, ranks).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).view(pa.string())], ["doc_id", "text"])


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of ``encoded``, from their ids and ends. Lists that are null give an empty text."""
    return tokens.select("doc_id", "ids", "ends").mapInArrow(lambda batches: _decode_batches(batches, path), "doc_id long, text string")
