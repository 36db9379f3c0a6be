"""BPE encoding and decoding of whole texts, equal to what the tokenizers library gives for the same vocabulary file.

Texts are split into pieces by one scan; each distinct piece of a slice that is not in the bounded cache goes to the
encoder. The encoder keeps a pair occurrence index: every mergeable pair of adjacent symbols maps to all its positions
over all pieces; active ranks are applied in ascending order, each at all its positions at once, and the lists of the
pairs that appear beside a merge are updated. A merge that makes a pair of a lower rank than itself (possible only where
one symbol can be made in two ways) sends that piece to the plain loop, which merges one pair at a time.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import kept, table, text_slices

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
NO_RANK = np.int64(1 << 40)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary files: itself, or the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


# Splitters: the patterns of the vocabulary files over Latin-1 bytes, and over any text. Fixed values of the format.
LETTER1, DIGIT1, SPACE1 = rb"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", rb"0-9\xb2\xb3\xb9\xbc-\xbe", rb"\x09-\x0d\x20\x85\xa0"
WORD_SPLIT = (re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[" + LETTER1 + rb"]+|[" + DIGIT1 + rb"]|[^" + SPACE1 + LETTER1 + DIGIT1 + rb"]+"), regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"))
BYTE_SPLIT = (
    re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?[" + LETTER1 + rb"]+| ?[" + DIGIT1 + rb"]+| ?[^" + SPACE1 + LETTER1 + DIGIT1 + rb"]+|[" + SPACE1 + rb"]+(?![^" + SPACE1 + rb"])|[" + SPACE1 + rb"]+"),
    regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"),
)


#: For each Latin-1 byte: 0 white space, 1 letter, 2 digit, 3 anything else.
KIND1 = bytes(next((kind for kind, chars in enumerate((SPACE1, LETTER1, DIGIT1)) if re.match(rb"[" + chars + rb"]", bytes([b]))), 3) for b in range(256))


def byte_pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(the pieces of Latin-1 texts as BYTE_SPLIT gives them, as large_binary; the number of pieces of each text), an array operation at a time."""
    data, sizes = b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts))
    raw, n, ends = np.frombuffer(data, np.uint8), len(data), np.cumsum(sizes)
    first = np.zeros(n + 1, bool)  # where a text starts
    first[ends - sizes] = True
    first[n] = True
    kind = np.frombuffer(data.translate(KIND1), np.uint8)
    starts = first.copy()
    starts[1:n] |= kind[1:] != kind[:-1]
    # the last white space before anything else is apart from the rest of its run, and a blank belongs to what follows
    last = np.flatnonzero((kind == 0) & starts[1:] & ~first[1:])
    starts[last] = True
    starts[last[raw[last] == 32] + 1] = False
    # contractions: an apostrophe that starts a piece
    for at in np.flatnonzero((raw == 39) & starts[:-1]).tolist():
        if not first[at + 1] and starts[at + 1]:
            size = 2 if data[at + 1] in b"stmd" else 3 if data[at + 1 : at + 3] in (b"re", b"ve", b"ll") and not first[at + 2] else 0
            if size:
                starts[at + 1] = False
                starts[at + size] = True
    offsets = np.flatnonzero(starts)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]), np.diff(np.searchsorted(offsets, np.append(ends - sizes, n)))


class Bpe:
    """A vocabulary file, loaded once per process by `bpe()`."""

    def __init__(self, path: str, library: bool = False, cache_bytes: int = 2 << 20):
        """library: new pieces go to the tokenizers library's own model, not to the pair occurrence index, whose tables are then
        not built. cache_bytes: bound on the cached pieces' characters (about 250,000 pieces); beyond it they are forgotten."""
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab, self.suffix, self.cache_bytes = model["vocab"], model["end_of_word_suffix"] or "", cache_bytes
        self.lower = spec["normalizer"] is not None
        self.split = WORD_SPLIT if self.suffix else BYTE_SPLIT
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        chars = byte_chars()
        self.shown = "".join(chars)
        self.cached: dict[bytes | str, bytes] = {}
        self.held = 0
        self.library = self.newest = None
        if library:
            from tokenizers import Tokenizer

            self.library, self.vocab = Tokenizer.from_file(path), None
            return
        self.start = np.array([self.vocab[c] for c in chars])
        self.last = np.array([self.vocab[c + self.suffix] for c in chars])
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        code = np.array([self.vocab[a] << 20 | self.vocab[b] for a, b in merges])
        self.made = np.array([self.vocab[a + b] for a, b in merges])
        self.pair_a, self.pair_b = (code >> 20).tolist(), (code & 0xFFFFF).tolist()
        order = np.argsort(code, kind="stable")
        self.codes, self.code_ranks = code[order], order
        self.rank_of = {int(c): r for r, c in reversed(list(enumerate(code)))}

    def forget(self) -> None:
        """Drops the cached pieces."""
        self.cached, self.held = {}, 0

    # encoding

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a << 20 | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_ranks[at], NO_RANK)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Pieces (UTF-8, not empty) -> ids, by the pair occurrence index."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        sym = self.start[raw]
        sym[ends - 1] = self.last[raw[ends - 1]]
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends - 1] = -1
        prv[ends - sizes] = -1
        odd: set[int] = set()

        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray, now: int) -> None:
            """Puts the pairs that begin at these positions into the index."""
            rank = self._ranks(sym[at], sym[nxt[at]])
            known = rank < NO_RANK
            at, rank = at[known], rank[known]
            if not len(at):
                return
            if now >= 0 and rank.min() < now:
                odd.update(np.searchsorted(ends, at[rank < now], side="right").tolist())
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                r, p = int(rank[s]), at[s:e]
                if r in places:
                    places[r].append(p)
                else:
                    places[r] = [p]
                    heapq.heappush(active, r)

        add(np.flatnonzero(nxt >= 0), -1)
        while active:
            r = heapq.heappop(active)
            at = places.pop(r)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else np.unique(at[0])
            a, b = self.pair_a[r], self.pair_b[r]
            at = at[(sym[at] == a) & (sym[nxt[at]] == b) & (nxt[at] >= 0)]  # a dead position has symbol -1
            if not len(at):
                continue
            if a == b and len(at) > 1:  # a pair of one symbol overlaps itself: every second of a chain
                chained = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
                head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - head) % 2 == 0]
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = self.made[r]
            sym[gone] = -1
            nxt[at] = after
            inner = after >= 0
            prv[after[inner]] = at[inner]
            left = prv[at]
            add(np.concatenate([at[inner], left[left >= 0]]), r)
        keep = np.flatnonzero(sym >= 0)
        out = np.split(sym[keep], np.searchsorted(keep, ends[:-1]))
        for i in odd:
            out[i] = self.encode_one(pieces[i])
        return out

    def encode_one(self, piece: bytes) -> np.ndarray:
        """One piece by the plain loop: the lowest rank first, the leftmost of its positions first."""
        syms = [int(self.start[b]) for b in piece]
        syms[-1] = int(self.last[piece[-1]])
        while len(syms) > 1:
            rank, at = min((self.rank_of.get(a << 20 | b, 1 << 40), i) for i, (a, b) in enumerate(zip(syms, syms[1:], strict=False)))
            if rank == 1 << 40:
                break
            syms[at : at + 2] = [int(self.made[rank])]
        return np.array(syms)

    def _pieces(self, text: str) -> list:
        """The pieces of a text without special tokens: Latin-1 bytes, or str where that does not do."""
        raw = text
        if self.lower:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = text.lower()
        try:
            return self.split[0].findall(text.encode("latin-1"))
        except UnicodeEncodeError:
            return self._any_pieces(raw, text)

    def _any_pieces(self, raw: str, text: str) -> list[str]:
        """Pieces of a text beyond Latin-1. Characters that this Python's data lacks are split by the library, since the
        library, this Python and the regex module may each know another version of Unicode."""
        if not self.lower or all(unicodedata.category(c) != "Cn" for c in set(raw)):
            return self.split[1].findall(text)
        if self.newest is None:
            from tokenizers import Tokenizer

            self.newest = self.library or Tokenizer.from_file(self.path)
        text = self.newest.normalizer.normalize_str(raw)
        return [text[s:e] for _, (s, e) in self.newest.pre_tokenizer.pre_tokenize_str(text)]

    def _parts(self, text: str) -> Iterator[list | int]:
        """The text's pieces, between the ids of special tokens in it."""
        for x in self.special_split.split(text) if any(s in text for s in self.special) else (text,):
            if x in self.special:
                yield self.special[x]
            elif x:
                yield self._pieces(x)

    def _learn(self, pieces: list) -> None:
        """Puts the ids of new pieces into the cache."""
        self.held += sum(map(len, pieces))
        raw = [p if type(p) is bytes and p.isascii() else p.decode("latin-1").encode() if type(p) is bytes else p.encode() for p in pieces]
        if self.library:
            tokenize, ends = self.library.model.tokenize, np.cumsum([0, *map(len, raw)]).tolist()
            shown = codecs.charmap_decode(b"".join(raw), "strict", self.shown)[0]
            flat: list[int] = []
            cuts = [0]
            for s, e in zip(ends, ends[1:], strict=False):
                flat += [t.id for t in tokenize(shown[s:e])]
                cuts.append(4 * len(flat))
            data = np.array(flat, "<u4").tobytes()
            ids = [data[s:e] for s, e in zip(cuts, cuts[1:], strict=False)]
        else:
            ids = (x.astype("<u4").tobytes() for x in self.encode_pieces(raw))
        self.cached.update(zip(pieces, ids, strict=True))

    def encode_slice(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers. Special tokens in a text count as such."""
        if self.held > self.cache_bytes:
            self.forget()
        if self.split is not BYTE_SPLIT or self.lower:
            yield from self._encode_each(texts)
            return
        whole, other = {}, []
        for i, t in enumerate(texts):
            try:
                whole[i] = t.encode("latin-1")
            except UnicodeEncodeError:
                other.append(i)
                continue
            if any(s in t for s in self.special):
                del whole[i]
                other.append(i)
        ids = dict(zip(whole, self._encode_whole(list(whole.values())), strict=True))
        ids.update(zip(other, self._encode_each([texts[i] for i in other]), strict=True))
        for i in range(len(texts)):
            yield ids.pop(i)

    def _encode_whole(self, texts: list[bytes]) -> list[bytes]:
        """Latin-1 texts without special tokens: each distinct piece of the slice is looked up once."""
        pieces, counts = byte_pieces(texts)
        coded = pieces.dictionary_encode()
        at, data = np.frombuffer(coded.dictionary.buffers()[1], np.int64)[: len(coded.dictionary) + 1].tolist(), (coded.dictionary.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        own = [data[s:e] for s, e in zip(at, at[1:], strict=False)]
        found = list(map(self.cached.get, own))
        if new := [p for p, x in zip(own, found, strict=True) if x is None]:
            self._learn(new)
            found = map(self.cached.__getitem__, own)
        ids = pa.array(found, pa.large_binary(), size=len(own)).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.append(0, np.cumsum(counts))].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[s:e]) for s, e in zip(ends, ends[1:], strict=False)]

    def _encode_each(self, texts: list[str]) -> Iterator[bytes]:
        parts, new = [list(self._parts(t)) for t in texts], set()
        for own in parts:
            for x in own:
                if type(x) is list:
                    new.update(set(x).difference(self.cached))
        if new:
            self._learn(list(new))
        get = self.cached.__getitem__
        for own in parts:
            yield b"".join([b"".join(map(get, x)) if type(x) is list else x.to_bytes(4, "little") for x in own])

    # decoding

    @cached_property
    def strings(self) -> list[str]:
        known = [*(self.vocab or self.library.get_vocab(False)).items(), *self.special.items()]
        out = [""] * (1 + max(i for _, i in known))
        for s, i in known:
            out[i] = s
        return out

    @cached_property
    def token_bytes(self) -> list[bytes]:
        back = {c: b for b, c in enumerate(byte_chars())}
        return [bytes(map(back.__getitem__, s)) if all(c in back for c in s) else s.encode() for s in self.strings]

    def decode(self, ids: bytes) -> bytes:
        """Ids as from encode_slice -> the library's decoded text in UTF-8."""
        if self.suffix:  # no decoder in the file: tokens with a space between them
            return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).encode()
        out = b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out.decode("utf-8", "replace").encode()


def bpe(path: str, library: bool = False, cache_bytes: int = 2 << 20) -> Bpe:
    if (path, library, cache_bytes) not in kept:
        kept[path, library, cache_bytes] = Bpe(path, library, cache_bytes)
    return kept[path, library, cache_bytes]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 5 << 20) -> DataFrame:
    """id, ids (binary: little-endian unsigned 32-bit integers), one row per input row. Null text counts as empty.

    path: the vocabulary file, on every executor. No limit on the length of a text; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = bpe(path)
        for b in text_slices(batches, slice_bytes):
            ids = list(tok.encode_slice([t or "" for t in b.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, pa.binary())], names=["id", "ids"])

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "id bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """id, ids -> id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = bpe(path)
        for b in text_slices(batches, 4 << 20, "ids"):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([tok.decode(x or b"").decode() for x in b.column("ids").to_pylist()], pa.string())], names=["id", "text"])

    return encoded.select("id", "ids").mapInArrow(run, "id bigint, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 5 << 20) -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, without moving ids between processes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = bpe(path)
        for b in text_slices(batches, slice_bytes):
            n, a, d = [], [], []
            for ids in tok.encode_slice([t or "" for t in b.column("text").to_pylist()]):
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                d.append(hashlib.sha256(tok.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"`{id_col}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary_path(WORD_BPE))
