"""Byte-pair encoding and decoding with forced boundaries.

Method. A pair of bytes that occurs inside no token of the vocabulary can't be merged over, so the
text is certainly cut there, and what lies between cuts is encoded alone. Before the pre-tokenizer's
pattern only those cuts are used that can't change what the pattern does, which are the ones in front
of a space; they part a text into about words, and equal fragments are encoded once and remembered.
Inside a fragment the pattern runs, then all forced cuts, then the merges by rank. Segments between cuts are
independent, so those of many fragments are merged together: each round makes the first merge of every segment.

Results equal the tokenizers library's for the same file (add_special_tokens=False); added tokens in a
text are taken as such, as there. Defined results: null text counts as empty: no tokens, empty
decoding; texts of any length are encoded whole, with a heap for segments of many symbols; equal
rows each come back; an empty table gives an empty result; other columns are ignored; a vocabulary with
ids of 65,536 or more raises ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, compress, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back

#: The byte-level pre-tokenizer's pattern (fixed value); white space is Unicode's, without the separators \x1c-\x1f.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
#: Fragments remembered by a worker: two generations of so many, about 45 MB together. Below 174,762 a table has 2**18 places.
REMEMBERED = 120_000
#: Fragments looked up at once, characters of unknown fragments encoded at once, segments merged at once (7 MB at most).
BLOCK, UNKNOWN, SEGMENTS = 1 << 16, 1 << 18, 8192
#: Longest segment merged together with others, below 64: a pair's value is its rank << 6 and its row.
LONG = 48
NEVER = (1 << 31) - 1
#: The symbol in front of and behind a segment, no token's id; what a merge swallowed.
NONE, GONE = 1 << 16, -1
#: Unicode's white space other than the space (fixed value).
WHITE = "\t\n\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_CODES = [32, *map(ord, WHITE)]


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    signs.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))})
    return signs


def compile_vocabulary(content: str) -> dict:
    """What encoding and decoding need of a tokenizer file, as arrays: made once on the driver, about 2 MB for 50,257 tokens."""
    spec = json.loads(content)
    signs = _byte_signs()
    vocab = spec["model"]["vocab"]
    if max(vocab.values()) >= 1 << 16:
        raise ValueError("a vocabulary may have 65,536 ids at most: they are kept as 16-bit integers")
    raw = {i: bytes(signs[c] for c in t) for t, i in vocab.items()}
    byte_id = [0] * 256
    inside = np.zeros((256, 256), bool)
    for i, b in raw.items():
        if len(b) == 1:
            byte_id[b[0]] = i
        x = np.frombuffer(b, np.uint8)
        inside[x[:-1], x[1:]] = True
    rank: dict[int, int] = {}
    for n, m in enumerate(spec["model"]["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        rank.setdefault(vocab[a] << 16 | vocab[b], n << 16 | vocab[a + b])
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    tokens = raw | {i: t.encode() for t, i in added.items()}
    top = max(tokens) + 1
    return {
        "byte_id": byte_id,
        "inside": inside.tobytes(),
        "pairs": np.fromiter(rank.keys(), np.uint32, len(rank)),
        "merged": np.fromiter(rank.values(), np.uint64, len(rank)),
        "added": added,
        "size": np.array([len(tokens.get(i, b"")) for i in range(top)]),
        "bytes": b"".join(tokens.get(i, b"") for i in range(top)),
    }


class ByteBpe:
    """An encoder and decoder for the content of a tokenizer file of byte-level BPE, or for what ``compile_vocabulary`` made of it."""

    def __init__(self, content: str | dict):
        vocabulary = compile_vocabulary(content) if isinstance(content, str) else content
        self.byte_id, self.added = vocabulary["byte_id"], vocabulary["added"]
        #: (left << 16 | right) -> (rank << 16 | merged), so that the least value is the first merge.
        self.rank: dict[int, int] = dict(zip(vocabulary["pairs"].tolist(), vocabulary["merged"].tolist()))
        #: For each pair of bytes (first << 8 | second) whether it occurs inside a token.
        inside = vocabulary["inside"]
        self.inside = np.frombuffer(inside, bool)
        # In front of a space the pattern parts whatever isn't white space; after white space the cut is certain
        # only where the pair never occurs inside a token. These white-space signs don't allow a cut:
        self.unsure = [w for w in WHITE if inside[w.encode()[-1] << 8 | 32]]
        self.words = re.compile(r" *[^ ]+| +")
        self.fragments = regex.compile(r"(?<=[^ " + "".join(map(regex.escape, self.unsure)) + r"])(?= )", regex.V1)
        self.pattern = regex.compile(PATTERN)
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        #: Codes of fragments in two generations.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._hash_ranks(vocabulary["pairs"].astype(np.int64), (vocabulary["merged"] >> np.uint64(16)).astype(np.int64), (vocabulary["merged"] & np.uint64(0xFFFF)).astype(np.int32))
        self.size = vocabulary["size"]
        self.place = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(vocabulary["bytes"], np.uint8)

    def _hash_ranks(self, pairs: np.ndarray, ranks: np.ndarray, merged: np.ndarray) -> None:
        """Ranks of pairs for ``_ranks``: a table with linear probing, at most a quarter full."""
        self.bits = max(8, (4 * len(pairs)).bit_length())
        key, value = (pairs >> 16) << 17 | pairs & 0xFFFF, np.argsort(np.argsort(ranks)).astype(np.int32) << 6
        self.merged = merged[np.argsort(ranks)]
        self.keys, self.values = np.full(1 << self.bits, -1), np.full(1 << self.bits, NEVER, np.int32)
        at = self._hash(key)
        while len(key):
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.values[at[put]] = key[put], value[put]
            rest = np.ones(len(key), bool)
            rest[put] = False
            key, value, at = key[rest], value[rest], (at[rest] + 1) & (1 << self.bits) - 1
        ids = np.array(self.byte_id, np.int32)
        self.byte_ids = ids
        #: The same for two bytes (first << 8 | second), where merging begins.
        self.first = self._ranks(np.repeat(ids, 256), np.tile(ids, 256))

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 6 of each pair of ids, NEVER where it has none."""
        key = left.astype(np.int64) << 17 | right
        at = self._hash(key)
        got = self.keys[at]
        out = self.values[at]
        other = np.flatnonzero(got != key)
        out[other] = NEVER
        other = other[got[other] >= 0]
        while len(other):
            at[other] = (at[other] + 1) & (1 << self.bits) - 1
            got = self.keys[at[other]]
            hit = got == key[other]
            out[other[hit]] = self.values[at[other[hit]]]
            other = other[~hit & (got >= 0)]
        return out

    def _merge(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, symbols: np.ndarray) -> None:
        """Merges by rank inside segments of 2 to LONG bytes of ``x``, leftmost first: a segment's symbols are a column, a round
        makes one merge in each. ``symbols`` gets the ids, GONE where a merge swallowed one; ``x`` has LONG bytes more than the segments."""
        n, rows = len(start), int(size.max())
        row = np.arange(rows)[:, None]
        place, there = start + row, row < size
        ids = np.full((rows + 1, n), NONE, np.int32)
        np.copyto(ids[:-1], self.byte_ids[x[place]], where=there)
        pair = np.full((rows + 1, n), NEVER, np.int32)
        np.copyto(pair[:-1], self.first[x[place].astype(np.int32) << 8 | x[place + 1]] | row.astype(np.int32), where=row < size - 1)
        after, before = np.empty((rows + 1, n), np.int64), np.empty((rows + 1, n), np.int64)
        after[:], before[:] = np.minimum(np.arange(1, rows + 2), rows)[:, None], np.arange(-1, rows)[:, None]
        before[0] = rows  # the last row has NONE and no pairs
        flat, after, before, column = ids.ravel(), after.ravel(), before.ravel(), np.arange(n)
        while True:
            best = pair.min(axis=0)
            live = np.flatnonzero(best != NEVER)
            if not len(live):
                break
            best = best[live]
            if len(live) < 0.75 * len(column):
                pair, column, live = pair.take(live, axis=1), column[live], np.arange(len(live))
            m, at = len(column), column[live]
            k = (best & 63).astype(np.int64)
            p = k * n + at
            j = after[p]
            q = j * n + at
            end = after[q]
            i = before[p]
            new = self.merged[best >> 6]
            flat[p], flat[q] = new, GONE
            after[p] = end
            r = end * n + at
            before[r] = k
            value = self._ranks(np.concatenate([new, flat[i * n + at]]), np.concatenate([flat[r], new]))
            cells = pair.ravel()
            cells[j * m + live] = NEVER
            cells[k * m + live] = value[: len(k)] | k.astype(np.int32)
            cells[i * m + live] = value[len(k) :] | i.astype(np.int32)
        symbols[place[there]] = ids[:-1][there]

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for n symbols."""
        rank, n = self.rank, len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := rank.get(ids[k] << 16 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, k, a, b = heapq.heappop(heap)
            j = after[k] if alive[k] else n
            if j >= n or ids[k] != a or ids[j] != b:
                continue
            ids[k], alive[j] = best & 0xFFFF, False
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank.get(ids[k] << 16 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
            if (i := before[k]) >= 0 and (r := rank.get(ids[i] << 16 | ids[k])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[k]))
        return [x for x, live in zip(ids, alive) if live]

    def _encode_fragments(self, fragments: list[str]) -> dict[str, bytes]:
        """The code of each fragment; none is empty."""
        # The pattern parts two fragments where the first doesn't end in white space and the second begins with a space,
        # whatever else is in them: such fragments go through it as one text.
        long = np.fromiter(map(len, fragments), np.int64, len(fragments))
        signs = np.frombuffer("".join(fragments).encode("utf-32-le"), "<u4")
        last = np.cumsum(long) - 1
        joined = (signs[last - long + 1] == 32) & ~np.isin(signs[last], WHITE_CODES)
        alone = [fragments[k] for k in np.flatnonzero(~joined)]
        fragments = [*compress(fragments, joined.tolist()), *alone]
        long = np.concatenate([long[joined], long[~joined]])
        pieces = self.pattern.findall("".join(fragments[: len(fragments) - len(alone)]))
        for text in alone:
            pieces += self.pattern.findall(text)
        return dict(zip(fragments, self._encode_pieces(pieces, long)))

    def _encode_pieces(self, pieces: list[str], long: np.ndarray) -> list[bytes]:
        """The codes of fragments of so many characters, in the pattern's pieces."""
        raw = "".join(pieces).encode()
        x = np.frombuffer(raw + bytes(LONG + 1), np.uint8)
        total = len(raw)
        at = np.append(np.flatnonzero((x[:total] & 0xC0) != 0x80), total)  # bytes where characters begin
        cut = np.ones(total + 1, bool)
        cut[1:-1] = ~self.inside[x[: total - 1].astype(np.int32) << 8 | x[1:total]]
        cut[at[np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))]] = True
        start = np.flatnonzero(cut)
        start, size = start[:-1], np.diff(start)
        symbols = self.byte_ids[x[:total]]
        order = np.argsort(np.minimum(size, LONG + 1).astype(np.int16), kind="stable")  # few bytes for padding
        lo, hi = np.searchsorted(size[order], [2, LONG + 1]) if len(order) else (0, 0)
        for k in range(lo, hi, SEGMENTS):
            some = order[k : min(k + SEGMENTS, hi)]
            self._merge(x, start[some], size[some], symbols)
        for k in order[hi:].tolist():
            a, n = int(start[k]), int(size[k])
            ids = self._merge_long(symbols[a : a + n].tolist())
            symbols[a : a + len(ids)], symbols[a + len(ids) : a + n] = ids, GONE
        kept = symbols != GONE
        coded = symbols[kept].astype("<u4").tobytes()
        ends = np.append(0, 4 * np.cumsum(kept))[at[np.cumsum(long)]].tolist()
        return [coded[a:b] for a, b in pairwise(chain([0], ends))]

    def _encode_huge(self, fragment: str) -> bytes:
        pieces = self.pattern.findall(fragment)
        parts = [pieces[lo:hi] for lo, hi in pairwise(self._slices(pieces))]
        return b"".join(self._encode_pieces(some, np.array([sum(map(len, some))]))[0] for some in parts)

    def _codes(self, parts: list[str]) -> list[bytes]:
        """The fragments' codes: those remembered, the others encoded together."""
        codes = list(map(self.memo.get, parts))
        if None not in codes:
            return codes
        at = [k for k, code in enumerate(codes) if code is None]
        found = dict.fromkeys([parts[k] for k in at])
        found = dict(zip(found, map(self.older.get, found)))
        wanted = [key for key, code in found.items() if code is None]
        if sum(map(len, wanted)) > UNKNOWN:
            found.update((key, self._encode_huge(key)) for key in wanted if len(key) > UNKNOWN)
            wanted = [key for key in wanted if len(key) <= UNKNOWN]
        for lo, hi in pairwise(self._slices(wanted)):
            found.update(self._encode_fragments(wanted[lo:hi]))
        for k in at:
            codes[k] = found[parts[k]]
        if max(map(len, found)) > 64:
            found = {key: code for key, code in found.items() if len(key) <= 64}
        if len(self.memo) + len(found) > REMEMBERED:
            self.older, self.memo = self.memo, found
        else:
            self.memo.update(found)
        return codes

    @staticmethod
    def _slices(texts: list[str]) -> list[int]:
        """Bounds of slices of about UNKNOWN characters."""
        if not texts:
            return []
        size = np.fromiter(accumulate(map(len, texts)), np.int64, len(texts))
        return [0, *(np.flatnonzero(np.diff(size // UNKNOWN)) + 1).tolist(), len(texts)]

    def _parts(self, text: str) -> list[str]:
        if not text:
            return []
        return self.fragments.split(text) if any(w + " " in text for w in self.unsure) else self.words.findall(text)

    def _encode_plain(self, text: str) -> bytes:
        parts = self._parts(text)
        return b"".join(b"".join(self._codes(parts[k : k + BLOCK])) for k in range(0, len(parts), BLOCK))

    def encode(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        if self.special and any(t in text for t in self.added):
            return b"".join(self.added[t].to_bytes(4, "little") if t in self.added else self._encode_plain(t) for t in self.special.split(text))
        return self._encode_plain(text)

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode`` of each text; those of few fragments are looked up together."""
        parts: list[str] = []
        ends: list[int] = [0]

        def done() -> Iterator[bytes]:
            codes = self._codes(parts)
            yield from (b"".join(codes[a:b]) for a, b in pairwise(ends))
            parts.clear()
            ends[1:] = []

        for text in texts:
            if len(text) > UNKNOWN or self.special and any(t in text for t in self.added):
                yield from done()
                yield self.encode(text)
                continue
            parts += self._parts(text)
            ends.append(len(parts))
            if len(parts) >= BLOCK:
                yield from done()
        yield from done()

    def decode(self, ids: bytes) -> str:
        """The text of the ids; bytes that aren't UTF-8 become U+FFFD."""
        x = np.frombuffer(ids, "<u4").astype(np.int64)
        size = self.size[x]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(x) else 0
        at = np.repeat(self.place[x] - ends + size, size) + np.arange(total)
        return self.bytes[at].tobytes().decode("utf-8", "replace")


_loaded: dict[str, ByteBpe] = {}


def encode_documents(docs: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; with ``keep_ids`` also ids (binary) and decoded text.

    ``vocabulary`` is the path of a tokenizer file on the driver; what is needed of it goes to the
    executors with the tasks (2 MB for the file of 50,257 tokens), so they need no copy of the file.
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = f.read()
    name = hashlib.sha256(content.encode()).hexdigest()
    compiled = docs.sparkSession.sparkContext.broadcast(compile_vocabulary(content))
    kind = docs.schema["doc_id"].dataType.simpleString()
    extra = "encoded binary, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _loaded:
            _loaded[name] = ByteBpe(compiled.value)
        bpe = _loaded[name]
        for batch in batches:
            counts, hashes, back, ids, texts = [], [], [], [], []
            for coded in bpe.encode_all(value.as_py() or "" for value in batch.column(1)):
                text = bpe.decode(coded)
                counts.append(len(coded) // 4)
                hashes.append(hashlib.sha256(coded).hexdigest())
                back.append(hashlib.sha256(text.encode()).hexdigest())
                if keep_ids:
                    ids.append(coded)
                    texts.append(text)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
                names += ["encoded", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (f", {extra}" if extra else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
