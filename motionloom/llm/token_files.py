"""Token-id files: an adaptive context-mixing range coder in independently reset, checksummed blocks.

Model. A block is up to BLOCK ids, and its coder starts from nothing. Order 2 predicts the id that last followed the two
ids before (by a 16-bit hash), order 1 the id that last followed the id before, order 0 a distribution over all ids. The
mixture gives the order-2 id the weight w2, the order-1 id w1 and the order-0 distribution w0; the weights are counts of
which order was right lately, in the context of which orders were right at the two places before, and old successes fade.
Order 0 weighs ids by their counts in the part of the block's order-0 ids that is already coded (renewed whenever that
part doubles); ids that are new get the share that ids seen once have, by 64 classes of 1024 ids and evenly inside those.

Coder. Range coding with 48-bit ranges and 16-bit words. A block's ids are dealt to up to STREAMS streams, each a coder of
its own, which share the block's model. First the orders of all places are coded, then the order-0 ids; neither needs the
ids of the other places, so that all streams of many blocks move side by side, an array operation at a time. The decoder
then replays the predictions, again over many blocks at once.

File: MAGIC; the blocks' payloads (words of each stream, then the words); a footer with per block (ids, bytes, crc32 of its
ids) and per document (id, ids); the footer's length, crc32 and MAGIC again. A block can be read alone.

Defined results: null text is empty and has the end id alone; rows without id come first; rows that share an id are
ordered by a hash of the text and then the text, so equal ids give the same files whenever a task is repeated; repeated
rows repeat. An empty table gives no file and an empty result. Texts of any length are coded whole, across blocks. Other
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.llm.bpe import BYTE_BPE, bpe, vocabulary_path
from motionloom.llm.common import AtomicFile, file_system, fresh_dir, small_batches, table, text_slices

MAGIC = b"MLTOKEN2"
BLOCK, STREAMS, LEAST_STREAM = 1 << 15, 32, 1024
#: Blocks whose streams are coded side by side, and blocks whose predictions are replayed side by side.
CODED, REPLAYED = 256, 256
#: Steps whose symbols are looked up together.
STEPS = 32
#: Bound on the characters of pieces whose ids a task keeps: about a million, 200 bytes each.
CACHE_BYTES = 8 << 20
BITS = 15
UNIT = 1 << BITS
CLASSES, RAW_BITS = 64, 10
FIRST_PART, RENEW, RECENT = 256, 4, 1024
M2, M1 = np.uint16(40503), np.uint16(30011)


def orders(ids: np.ndarray) -> np.ndarray:
    """For each id of a block (16-bit), which order predicts it: 0 order 2, 1 order 1, 2 neither."""
    b = np.concatenate((np.zeros(1, np.uint16), ids[:-1]))
    a = np.concatenate((np.zeros(1, np.uint16), b[:-1]))
    out = np.full(len(ids), 2, np.uint8)
    for order, key in ((1, b), (0, a * M2 + b * M1)) if len(ids) else ():
        at = np.argsort(key, kind="stable")
        key, own = key.take(at), ids.take(at)
        out[at[1:][(key[1:] == key[:-1]) & (own[1:] == own[:-1])]] = order
    return out


class Streams:
    """How the ids of a batch of blocks are dealt to streams: stream j of a block has its j-th stretch of places, and every
    STREAMS-th of the order-0 ids of a part."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.per = np.clip(sizes // LEAST_STREAM, 1, STREAMS)
        self.block = np.repeat(np.arange(len(sizes)), self.per)
        self.n = len(self.block)
        self.j = np.arange(self.n) - np.repeat(np.cumsum(self.per) - self.per, self.per)
        width = -(-sizes // self.per)
        begin = self.j * width[self.block]
        self.length = np.clip(sizes[self.block] - begin, 0, width[self.block])
        self.begin = (np.cumsum(sizes) - sizes)[self.block] + begin

    def lanes(self, length: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Streams with these lengths in an order in which those that take part in a step come first, and their number by step."""
        lane = np.argsort(-length, kind="stable")
        return lane, np.searchsorted(-length[lane], -np.arange(int(length.max(initial=0))), side="left").tolist()

    def part(self, counts: np.ndarray) -> np.ndarray:
        """How many of the order-0 ids of a part that has counts[block] fall to each stream."""
        return np.maximum(0, -(-(counts[self.block] - self.j) // self.per[self.block]))


class Encoder:
    """The streams' coders, in the order of the lanes that were set last; a step codes for the first of them."""

    def __init__(self, streams: int):
        self.low, self.span = np.zeros(streams, np.int64), np.full(streams, 1 << 48, np.int64)
        self.number = np.arange(streams, dtype=np.uint16 if streams <= 1 << 16 else np.int32)  # 16 bits sort faster
        self.who: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def set_lanes(self, lane: np.ndarray) -> None:
        back = np.argsort(self.number)[lane]
        self.low, self.span, self.number = self.low[back], self.span[back], self.number[back]

    def put(self, start: np.ndarray, freq: np.ndarray) -> None:
        """Codes one symbol of each of the first len(start) lanes."""
        low, span = self.low[: len(start)], self.span[: len(start)]
        span >>= BITS
        low += span * start
        span *= freq
        small = np.flatnonzero(span < 1 << 32)
        if len(small):
            self._move(small)

    def put_raw(self, who: np.ndarray, value: np.ndarray) -> None:
        """Codes RAW_BITS bits of each of these lanes."""
        span = self.span[who] >> BITS << BITS - RAW_BITS
        self.low[who] += span * value
        self.span[who] = span
        small = who[span < 1 << 32]
        if len(small):
            self._move(small)

    def _move(self, small: np.ndarray) -> None:
        out = self.low[small]
        self.who.append(self.number[small])
        self.words.append((out >> 32).astype(np.int32))  # bit 16: a carry into the word before
        self.low[small] = (out & 0xFFFFFFFF) << 16
        self.span[small] <<= 16

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        """All words, stream by stream, and the number of each stream's words. The reader takes zeros beyond a stream's end."""
        self.set_lanes(np.arange(len(self.number)))
        self.who.append(self.number)
        self.words.append(((self.low + 0xFFFFFFFF) >> 32).astype(np.int32))
        who, word = np.concatenate(self.who), np.concatenate(self.words)
        word = word[np.argsort(who, kind="stable")]
        while len(over := np.flatnonzero(word > 0xFFFF)):
            carry = word[over] >> 16
            word[over] &= 0xFFFF
            word[over - 1] += carry
        return word.astype("<u2"), np.bincount(who, minlength=len(self.number))


class Decoder:
    def __init__(self, words: np.ndarray, counts: np.ndarray):
        """words, counts: as from Encoder.close()."""
        ends = np.cumsum(counts + 3)
        self.data = np.zeros(int(ends[-1]) + 1, np.uint16)
        self.data[np.arange(len(words)) + np.repeat(3 * np.arange(len(counts)), counts)] = words
        self.at = ends - counts - 3
        first = self.data[self.at[:, None] + np.arange(3)].astype(np.int64)
        self.code = first[:, 0] << 32 | first[:, 1] << 16 | first[:, 2]
        self.at += 3
        self.span, self.number = np.full(len(counts), 1 << 48, np.int64), np.arange(len(counts))

    def set_lanes(self, lane: np.ndarray) -> None:
        back = np.argsort(self.number)[lane]
        self.code, self.span, self.at, self.number = self.code[back], self.span[back], self.at[back], self.number[back]

    def value(self, m: int) -> np.ndarray:
        """What the codes of the first m lanes stand for, under UNIT."""
        self.span[:m] >>= BITS
        # the quotient of whole numbers under 2^48, itself under 2^16, is as exact in doubles as in integers once cut
        return np.minimum((self.code[:m] / self.span[:m]).astype(np.int64), UNIT - 1)

    def take(self, start: np.ndarray, freq: np.ndarray) -> None:
        code, span = self.code[: len(start)], self.span[: len(start)]
        code -= span * start
        span *= freq
        small = np.flatnonzero(span < 1 << 32)
        if len(small):
            self._move(small)

    def take_raw(self, who: np.ndarray) -> np.ndarray:
        """RAW_BITS bits of each of these lanes."""
        code, span = self.code[who], self.span[who] >> BITS << BITS - RAW_BITS
        value = np.minimum((code / span).astype(np.int64), (1 << RAW_BITS) - 1)
        self.code[who], self.span[who] = code - span * value, span
        small = who[span < 1 << 32]
        if len(small):
            self._move(small)
        return value

    def _move(self, small: np.ndarray) -> None:
        at = self.at[small]
        self.code[small] = self.code[small] << 16 | self.data.take(at, mode="clip")  # a damaged block may ask for more
        self.span[small] <<= 16
        self.at[small] = at + 1


class Mixture:
    """The weights of the three orders, of which a place is (block * 9 + context) * 3 + order; the context: the orders right at
    the two places before in the stream, three times the earlier and the later."""

    def __init__(self, blocks: int):
        self.counts = np.ones((blocks * 9, 3), np.int64)
        self.held: list[np.ndarray] = []
        self.renew()

    def renew(self) -> None:
        if self.held:
            self.counts += np.bincount(np.concatenate(self.held), minlength=self.counts.size).reshape(-1, 3)
            self.held = []
        total = self.counts.sum(axis=1)
        old = total > RECENT
        self.counts[old] = (self.counts[old] + 1) >> 1
        total = self.counts.sum(axis=1)
        freq = 1 + self.counts * (UNIT - 3) // total[:, None]
        freq[:, 2] = UNIT - freq[:, 0] - freq[:, 1]
        self.freq = freq.ravel()
        self.start = (np.cumsum(freq, axis=1) - freq).ravel()

    def learn(self, at: np.ndarray) -> None:
        self.held.append(at)
        if len(self.held) == RENEW:
            self.renew()


def distribution(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order 0 after these order-0 ids of the block: the known ids, and the widths (sum UNIT) of these and then of the classes of new ids."""
    if len(before) < 1 << 12:  # sorting is cheaper than counting over all ids
        known, times = np.unique(before, return_counts=True)
        known = known.astype(np.int64)
    else:
        times = np.bincount(before)
        known = np.flatnonzero(times > 0)
        times = times[known]
    n, room = len(before), UNIT - len(known) - CLASSES
    once = max(1, int((times == 1).sum()))
    for_known = room * (n - once + 1) // (n + 1) if n else 0
    classes = np.bincount(known >> RAW_BITS, minlength=CLASSES) + 1
    width = np.concatenate((times * for_known // max(1, n), classes * (room - for_known) // int(classes.sum()))) + 1
    width[width.argmax()] += UNIT - int(width.sum())
    return known, width


def _parts(most: int) -> Iterator[tuple[int, int]]:
    """Ends of the parts of order-0 ids: every part but the first two doubles what is coded."""
    s, e = 0, FIRST_PART
    while s < most:
        yield s, e
        s, e = e, 2 * e


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Blocks of ids (under 65,536) -> payloads."""
    return [p for s in range(0, len(blocks), CODED) for p in _encode(blocks[s : s + CODED])]


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    blocks = [np.asarray(b).astype(np.uint16) for b in blocks]
    streams = Streams(np.array([len(b) for b in blocks]))
    coder, mix = Encoder(streams.n), Mixture(len(blocks))
    order_of = [orders(b) for b in blocks]
    order = np.concatenate(order_of)
    lane, active = streams.lanes(streams.length)
    coder.set_lanes(lane)
    begin, base, before = streams.begin[lane], streams.block[lane] * 27, np.full((2, streams.n), 2, np.uint8)
    for s in range(0, len(active), STEPS):
        m = active[s]
        right = np.concatenate((before[:, :m], order.take(begin[:m] + np.arange(s, min(len(active), s + STEPS))[:, None], mode="clip")))
        places, before = base[:m] + (9 * right[:-2] + 3 * right[1:-1] + right[2:]), right[-2:]
        for row, m in zip(places, active[s : s + STEPS], strict=True):
            at = row[:m]
            coder.put(mix.start.take(at), mix.freq.take(at))
            mix.learn(at)
    rest = [b[o == 2] for b, o in zip(blocks, order_of, strict=True)]
    sizes = np.array([len(x) for x in rest])
    where = np.zeros(1 << 16, np.int64)
    for s, e in _parts(int(sizes.max(initial=0))):
        starts, freqs, raws = [], [], []
        for x in rest:
            now = x[s:e]
            if len(now):
                known, width = distribution(x[:s])
                where[known] = np.arange(len(known))
                at = where[now]
                new = at >= len(known)
                new[~new] = known[at[~new]] != now[~new]
                at = np.where(new, len(known) + (now >> RAW_BITS), at)
                width = width.astype(np.int32)  # half the memory, as all blocks of a file may be coded at once
                starts.append((np.cumsum(width, dtype=np.int32) - width)[at])
                freqs.append(width[at])
                raws.append(np.where(new, (now & (1 << RAW_BITS) - 1).astype(np.int32), np.int32(-1)))
        counts = np.clip(sizes - s, 0, e - s)
        start, freq, raw = np.concatenate(starts), np.concatenate(freqs), np.concatenate(raws)
        lane, active = streams.lanes(streams.part(counts))
        coder.set_lanes(lane)
        first, step = ((np.cumsum(counts) - counts)[streams.block] + streams.j)[lane], streams.per[streams.block][lane]
        for t in range(0, len(active), STEPS):
            m = active[t]
            at = first[:m] + step[:m] * np.arange(t, min(len(active), t + STEPS))[:, None]
            for own, width, low, m in zip(start.take(at, mode="clip"), freq.take(at, mode="clip"), raw.take(at, mode="clip"), active[t : t + STEPS], strict=True):
                coder.put(own[:m], width[:m])
                if len(new := np.flatnonzero(low[:m] >= 0)):
                    coder.put_raw(new, low[new])
    words, counts = coder.close()
    out, w, c = [], 0, 0
    for per in streams.per.tolist():
        n = int(counts[c : c + per].sum())
        out.append(counts[c : c + per].astype("<u2").tobytes() + words[w : w + n].tobytes())
        w, c = w + n, c + per
    return out


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """Payloads of blocks, longest first, and their numbers of ids -> ids."""
    got: list[tuple[np.ndarray, np.ndarray]] = []
    for s in range(0, len(payloads), CODED):
        got += _decode(payloads[s : s + CODED], np.array(sizes[s : s + CODED]))
    return [x for s in range(0, len(got), REPLAYED) for x in _replay(got[s : s + REPLAYED])]


def _decode(payloads: list[bytes], sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per block: the order of each place, and the order-0 ids."""
    streams = Streams(sizes)
    counts = np.concatenate([np.frombuffer(p, "<u2", n) for p, n in zip(payloads, streams.per.tolist(), strict=True)]).astype(np.int64)
    words = np.concatenate([np.frombuffer(p, "<u2", offset=2 * n) for p, n in zip(payloads, streams.per.tolist(), strict=True)])
    if len(words) != counts.sum():
        raise ValueError("a block is damaged")
    coder, mix = Decoder(words, counts), Mixture(len(sizes))
    order = np.zeros(int(sizes.sum()), np.uint8)
    lane, active = streams.lanes(streams.length)
    coder.set_lanes(lane)
    begin, base, before, last = streams.begin[lane], streams.block[lane] * 27, np.full(streams.n, 2), np.full(streams.n, 2)
    for t, m in enumerate(active):
        at = base[:m] + (9 * before[:m] + 3 * last[:m])
        v = coder.value(m)
        own = (v >= mix.start.take(at + 1)).astype(np.int64)
        own += v >= mix.start.take(at + 2)
        at += own
        coder.take(mix.start.take(at), mix.freq.take(at))
        mix.learn(at)
        order[begin[:m] + t] = own
        before, last = last, own
    order_of = np.split(order, np.cumsum(sizes)[:-1])
    left = np.array([np.count_nonzero(o == 2) for o in order_of])
    rest = [np.zeros(n, np.uint16) for n in left]
    for s, e in _parts(int(left.max(initial=0))):
        counts = np.clip(left - s, 0, e - s)
        symbols, slots, at = [], np.zeros((len(sizes), UNIT), np.uint16), 0
        firsts = np.zeros(len(sizes), np.int64)
        for k, x in enumerate(rest):
            if counts[k]:
                known, width = distribution(x[:s])
                firsts[k] = at
                slots[k] = np.repeat(np.arange(len(width), dtype=np.uint16), width)
                # start, width and id (or 1 << 16 and a class) in one number, so that a symbol is one look-up
                symbols.append(np.concatenate((known, (1 << 16) + np.arange(CLASSES))) << 32 | width << 16 | np.cumsum(width) - width)
                at += len(width)
        symbols, slots = np.concatenate(symbols), slots.ravel()
        found = np.zeros(int(counts.sum()), np.uint16)
        lane, active = streams.lanes(streams.part(counts))
        coder.set_lanes(lane)
        block = streams.block[lane]
        place, step, slot_base, first = (np.cumsum(counts) - counts)[block] + streams.j[lane], streams.per[block], block * UNIT, firsts[block]
        for t, m in enumerate(active):
            sym = symbols.take(first[:m] + slots.take(slot_base[:m] + coder.value(m), mode="clip"))
            coder.take(sym & 0xFFFF, sym >> 16 & 0xFFFF)
            now = sym >> 32
            if len(new := np.flatnonzero(now >> 16)):
                now[new] = (now[new] & 0xFFFF) << RAW_BITS | coder.take_raw(new)
            found[place[:m] + step[:m] * t] = now
        for k, part in enumerate(np.split(found, np.cumsum(counts)[:-1])):
            rest[k][s : s + len(part)] = part
    return list(zip(order_of, rest, strict=True))


def _replay(blocks: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Orders and order-0 ids -> ids, blocks side by side, longest first."""
    sizes = np.array([len(o) for o, _ in blocks])
    n, longest = len(blocks), int(sizes.max(initial=0))
    order, out = np.full((longest, n), 2, np.uint8), np.zeros((longest, n), np.uint16)
    for k, (o, rest) in enumerate(blocks):
        order[: len(o), k] = o
        out[np.flatnonzero(o == 2), k] = rest
    # what is predicted, by step: the block, and its place in `key` below, which has a row for each order
    step, block = np.divmod(np.flatnonzero(order < 2), max(1, n))
    ends = np.searchsorted(step, np.arange(longest + 1)).tolist()
    active = np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()
    last = np.zeros(n << 17, np.uint16)  # of each block: the id that last followed two ids, by their hash, and one
    m, base, key = n, np.arange(n) * 2 << 16, np.zeros((2, n), np.int64)
    at = order[step, block].astype(np.int64) * n + block
    two, one, times2, times1 = *key, np.full(n, M2), np.full(n, M1)
    base1, a, b, h = base + (1 << 16), np.zeros(n, np.uint16), np.zeros(n, np.uint16), np.zeros(n, np.uint16)
    for t, n in enumerate(active):
        if n < m:
            m = n
            base, base1, two, one, times2, times1, a, b, h = (x[:n] for x in (base, base1, two, one, times2, times1, a, b, h))
        np.multiply(b, times1, out=h)
        np.add(h, a, out=h)
        np.add(base, h, out=two)
        np.add(base1, b, out=one)
        now = out[t, :n]
        s, e = ends[t], ends[t + 1]
        if s < e:
            own = block[s:e]
            now[own] = last.take(key.take(at[s:e]))
        last[two] = now
        last[one] = now
        np.multiply(b, times2, out=a)  # the id before the last, as the hash has it
        b = now
    return [out[:s, k] for k, s in enumerate(sizes.tolist())]


class TokenWriter:
    """One file. add() takes documents in order; ids are coded as soon as a batch of blocks is full."""

    def __init__(self, uri: str):
        self.file = AtomicFile(uri)
        self.file.write(MAGIC)
        self.docs: list[tuple[int | None, int]] = []
        self.blocks: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []
        self.size = 0

    def add(self, doc: int | None, ids: bytes) -> None:
        self.docs.append((doc, len(ids) // 4))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= 4 * BLOCK * REPLAYED:
            self._code(False)

    def _code(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        most = len(ids) if last else len(ids) // (BLOCK * REPLAYED) * BLOCK * REPLAYED
        for s in range(0, most, BLOCK * REPLAYED):
            blocks = [ids[k : min(k + BLOCK, most)] for k in range(s, min(most, s + BLOCK * REPLAYED), BLOCK)]
            for b, p in zip(blocks, encode_blocks(blocks), strict=True):
                self.file.write(p)
                self.blocks.append((len(b), len(p), zlib.crc32(b.tobytes())))
        self.held, self.size = [ids[most:].tobytes()], 4 * (len(ids) - most)

    def close(self) -> None:
        self._code(True)
        body = struct.pack("<II", len(self.blocks), len(self.docs)) + b"".join(struct.pack("<III", *b) for b in self.blocks) + b"".join(struct.pack("<?qQ", d is None, d or 0, n) for d, n in self.docs)
        self.file.write(body + struct.pack("<QI", len(body), zlib.crc32(body)) + MAGIC)
        self.file.close()


class TokenReader:
    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.uri, self.file = uri, fs.open_input_file(path)
        size = self.file.size()
        length, crc = struct.unpack("<QI", self.file.read_at(12, size - 20))
        body = self.file.read_at(length, size - 20 - length)
        if self.file.read_at(8, size - 8) != MAGIC or zlib.crc32(body) != crc:
            raise ValueError(f"{uri} is damaged")
        n, docs = struct.unpack_from("<II", body)
        self.blocks = list(struct.iter_unpack("<III", body[8 : 8 + 12 * n]))
        self.docs = [(None if none else d, k) for none, d, k in struct.iter_unpack("<?qQ", body[8 + 12 * n : 8 + 12 * n + 17 * docs])]

    def ids(self) -> Iterator[np.ndarray]:
        """The blocks' ids in order, a batch of blocks at a time in memory."""
        at = len(MAGIC)
        for s in range(0, len(self.blocks), REPLAYED):
            part = self.blocks[s : s + REPLAYED]
            data, payloads, k = self.file.read_at(sum(b[1] for b in part), at), [], 0
            for _, size, _ in part:
                payloads.append(data[k : k + size])
                k += size
            at += k
            for ids, (_, _, crc) in zip(decode_blocks(payloads, [b[0] for b in part]), part, strict=True):
                ids = ids.astype("<u4")
                if zlib.crc32(ids.tobytes()) != crc:
                    raise ValueError(f"a block of {self.uri} is damaged")
                yield ids

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        held, at, blocks = b"", 0, self.ids()
        for doc, n in self.docs:
            if at + 4 * n > len(held):
                parts = [held[at:]]
                have, at = len(parts[0]), 0
                while have < 4 * n:
                    parts.append(next(blocks).tobytes())
                    have += len(parts[-1])
                held = b"".join(parts)
            yield doc, held[at : at + 4 * n]
            at += 4 * n


def write(docs: DataFrame, path: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 5 << 20) -> DataFrame:
    """Writes the ids of all documents, end_id after each, in ascending id order (null ids first; equal ids by a hash of the text, then the text);
    returns the manifest: part, file, docs, tokens, one row per file, ordered by part. Files are written whole or not at
    all, under names of their own; the manifest is a table in folder that names those of committed tasks."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, out, uri, tokens = bpe(path, library=True, cache_bytes=CACHE_BYTES), None, f"{folder}/part-{uuid.uuid4().hex}.tok", 0
        for b in text_slices(batches, slice_bytes):
            for doc, ids in zip(b.column("id").to_pylist(), tok.encode_slice([t or "" for t in b.column("text").to_pylist()]), strict=True):
                out = out or TokenWriter(uri)
                out.add(doc, ids + end)
                tokens += len(ids) // 4 + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([uri]), pa.array([len(out.docs)], pa.int64()), pa.array([tokens], pa.int64())], names=["part", "file", "docs", "tokens"])

    schema = "part int, file string, docs bigint, tokens bigint"
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # a hash beside the id, so that one id with many texts is not all one task's
    dealt = src.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")
    with small_batches(docs.sparkSession, rows=4000):  # the fewer slices, the fewer look-ups of pieces
        dealt.drop("h").mapInArrow(run, schema).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(schema).parquet(f"{folder}/manifest")


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the files alone; one row per document."""
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, at in zip(b.column("file").to_pylist(), b.column("before").to_pylist(), strict=True):
                rows: list[list] = [[], [], [], []]
                for doc, ids in TokenReader(uri).documents():
                    for c, x in zip(rows, (doc, at, len(ids) // 4, zlib.crc32(ids)), strict=True):
                        c.append(x)
                    at += len(ids) // 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.withColumn("before", before).select("part", "file", "before")
    n = max(1, manifest.count())
    # by range, since hashed names would give some tasks several files and others none
    return files.repartitionByRange(n, "part").select("file", "before").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(write(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_BPE), fresh_dir(spark, "tokens")))
