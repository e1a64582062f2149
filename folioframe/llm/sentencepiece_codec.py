"""SentencePiece encoding and decoding by suffix-array matching.

A text is cut at the white space that no piece spans. The distinct cuts of a
batch that a worker has not met before are concatenated and indexed: suffixes
are sorted by as many characters as the longest piece has, every piece is
binary-searched for its range of suffixes, and each occurrence is an edge from
its start. Edges are put in order of position and relaxed. For a unigram model
that would be the best path; a model of merges, which this one is, is relaxed in
the order of its merges instead: of the edges that join two neighbouring symbols
the best-scored, then leftmost, is taken, until none joins any. Characters
without a piece become byte pieces. Results equal the library's.

Defined results: null and empty texts have no ids and decode to the empty
string; repeated rows are coded each; characters that the model writes spaces
with decode to spaces, as in the library. Only the named columns are read, so
other columns may have any name.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, arrow_schema, batch_of, id_and_text, slices

SPACE = "▁"
#: Cuts remembered by a worker, characters indexed at once, characters of a cut relaxed beside others.
REMEMBERED, INDEXED, ABREAST = 400_000, 400_000, 64


class Pieces:
    """The model's pieces, from the library; refuses models that this codec would not reproduce."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        kinds = {proto.ModelProto.SentencePiece.NORMAL, proto.ModelProto.SentencePiece.BYTE, proto.ModelProto.SentencePiece.CONTROL,
            proto.ModelProto.SentencePiece.UNKNOWN}
        if train.model_type != proto.TrainerSpec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix or {p.type for p in model.pieces} - kinds:
            raise ValueError("only merge models with identity normalisation and byte fallback are supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        normal = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == proto.ModelProto.SentencePiece.NORMAL]
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == proto.ModelProto.SentencePiece.BYTE}
        self.text = [p.piece if p.type == proto.ModelProto.SentencePiece.NORMAL else "" for p in model.pieces]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if max(len(p) for p, *_ in normal) > 255:
            raise ValueError("pieces of over 255 characters")
        if len(self.bytes) != 256 or any(SPACE in p.lstrip(SPACE) for p, *_ in normal):
            raise ValueError("pieces must have byte fallback and spaces only in front")
        single = sorted((ord(p), i) for p, i, _ in normal if len(p) == 1)
        self.single_code, self.single_id = (np.array(x) for x in zip(*single, strict=True))
        self.byte_id = np.array([self.bytes[b] for b in range(256)])
        self.longest = max(len(p) for p, *_ in normal)
        longer = [x for x in normal if len(x[0]) > 1]
        self.id = np.array([i for _, i, _ in longer])
        self.length = np.array([len(p) for p, *_ in longer])
        self.score = np.full(len(model.pieces) + 1, -np.inf)
        self.score[self.id] = [s for *_, s in longer]
        # the order of merges: pieces of equal score share a rank
        self.rank = np.searchsorted(np.unique(-self.score[self.id]), -self.score)
        self.chars = np.zeros((len(longer), self.longest), np.int64)
        for row, (p, *_) in enumerate(longer):
            self.chars[row, : len(p)] = [ord(c) for c in p]

    def edges(self, chars: np.ndarray) -> np.ndarray:
        """table[i, n]: the piece of n characters that starts at i, or -1: all edges by position.

        A long text is indexed stretch by stretch, each with as many characters
        more as a piece can have, so one long cut needs no more than the table.
        """
        if len(chars) <= INDEXED:
            return self._edges(chars)
        parts = (self._edges(chars[a : a + INDEXED + self.longest])[:INDEXED] for a in range(0, len(chars), INDEXED))
        table = np.empty((len(chars), self.longest + 1), np.int32)
        for k, part in enumerate(parts):
            table[k * INDEXED : k * INDEXED + len(part)] = part
        return table

    def _edges(self, chars: np.ndarray) -> np.ndarray:
        """The table of one stretch.

        Characters are numbered within it, so that as many as possible share a
        64-bit sort key; pieces with a character that it lacks are not searched
        for.
        """
        n, alphabet = len(chars), np.unique(chars[chars > 0])
        bits = (len(alphabet) + 2).bit_length()
        per = 63 // bits
        width = -(-self.longest // per)
        at = np.minimum(np.searchsorted(alphabet, self.chars), max(len(alphabet) - 1, 0))
        present = (self.chars == 0) | (alphabet[at] == self.chars) if len(alphabet) else self.chars == 0
        which = np.flatnonzero(present.all(axis=1))
        table = np.full((n, self.longest + 1), -1, np.int32)
        if not len(which):
            return table
        number = np.zeros((len(which), width * per), np.int64)
        number[:, : self.longest] = np.where(self.chars[which] > 0, at[which] + 1, 0)
        beyond = np.where(np.arange(width * per)[None, :] >= self.length[which, None], (1 << bits) - 1, number)
        text = np.zeros(n + width * per, np.int64)
        text[:n] = np.where(chars > 0, np.searchsorted(alphabet, chars) + 1, 0)
        packed = text[: len(text) - per + 1].copy()
        for k in range(1, per):
            packed = packed << bits | text[k : len(text) - per + 1 + k]
        keys = [packed[k * per : k * per + n] for k in range(width)]
        suffixes = np.lexsort(keys[::-1])
        ordered = [k[suffixes] for k in keys]
        pack = lambda m: np.stack([functools.reduce(lambda a, c: a << bits | m[:, c], range(k * per + 1, (k + 1) * per), m[:,
            k * per]) for k in range(width)], axis=1)
        first, last = self._search(ordered, pack(number), False), self._search(ordered, pack(beyond), True)
        times = last - first
        piece = np.repeat(np.arange(len(which)), times)
        offset = np.arange(len(piece)) - np.repeat(np.cumsum(times) - times, times)
        table[suffixes[first[piece] + offset], self.length[which][piece]] = self.id[which][piece]
        return table

    def ids_at(self, table: np.ndarray, chars: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols that start at ``at``, and where each symbol's ids begin; one entry more ends them."""
        code = chars[at]
        k = np.minimum(np.searchsorted(self.single_code, code), len(self.single_code) - 1)
        ids = np.where(size > 1, table[at, size], np.where(self.single_code[k] == code, self.single_id[k], -1))
        bare = ids < 0  # a character without a piece: its UTF-8 bytes
        n = np.where(bare, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        first = np.concatenate([[0], np.cumsum(n)])
        flat = np.empty(first[-1], np.int64)
        flat[first[:-1][~bare]] = ids[~bare]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for j in range(4):
            which = np.flatnonzero(bare & (n > j))
            c, m = code[which], n[which]
            low = c >> 6 * (m - 1 - j)
            flat[first[which] + j] = self.byte_id[low | lead[m] if j == 0 else low & 0x3F | 0x80]
        return flat, first

    def _search(self, ordered: list[np.ndarray], keys: np.ndarray, after: bool) -> np.ndarray:
        """For every piece, how many suffixes come before it (or, ``after``, are not after it)."""
        n = len(ordered[0])
        low, high = np.zeros(len(keys), np.int64), np.full(len(keys), n)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            less, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for k, column in enumerate(ordered):
                value, key = column[mid], keys[open_, k]
                less |= same & (value < key)
                same &= value == key
                if not same.any():
                    break
            right = less | same if after else less
            low[open_[right]], high[open_[~right]] = mid[right] + 1, mid[~right]
        return low


class Codec:
    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.known: dict[str, bytes] = {}
        # no piece has a space behind another character, so what lies between is coded alone
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def cuts(self, text: str) -> list[str]:
        return self.cut(self.pieces.prefix + text.replace(" ", SPACE))

    def learn(self, cuts: set[str]) -> None:
        """Code the cuts not met before, indexed some at a time."""
        fresh = [c for c in cuts if c not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:  # what this batch has too is what texts have often
            self.known = {c: self.known[c] for c in cuts if c in self.known}
        at = 0
        while at < len(fresh):
            total, end = 0, at
            while end < len(fresh) and (end == at or total + len(fresh[end]) < INDEXED):
                total += len(fresh[end]) + 1
                end += 1
            self._code(fresh[at:end])
            at = end

    def _code(self, cuts: list[str]) -> None:
        p = self.pieces
        joined = "\0".join(cuts)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        length = np.fromiter(map(len, cuts), np.int64, len(cuts))
        start = np.cumsum(length + 1) - length - 1
        # a character zero in a text must not end up in any key as a separator would: no piece has one
        table = p.edges(chars)
        symbols = np.zeros(len(chars) + 1, np.int64)
        short = length <= ABREAST
        self._abreast(table, start[short], length[short], symbols)
        for s, n in zip(start[~short].tolist(), length[~short].tolist(), strict=True):
            self._agenda(table, s, n, symbols)
        at = np.flatnonzero(symbols)
        ids, first = p.ids_at(table, chars, at, symbols[at])
        raw = ids.astype("<i4").tobytes()
        begin = first[np.searchsorted(at, start)] * 4
        end = first[np.searchsorted(at, start + length)] * 4
        self.known.update((c, raw[i:j]) for c, i, j in zip(cuts, begin.tolist(), end.tolist(), strict=True))

    def _abreast(self, table: np.ndarray, start: np.ndarray, length: np.ndarray, symbols: np.ndarray) -> None:
        """Relax short cuts side by side, a merge of each a round. Sets the symbols' lengths at their starts."""
        if not len(start):
            return
        p, low = self.pieces, 1
        for width in (4, 6, 8, 10, 12, 14, 16, 20, 28, 40, ABREAST):
            which = np.flatnonzero((length >= low) & (length <= width))
            low = width + 1
            if not len(which):
                continue
            column = np.arange(width)
            size = np.where(column[None, :] < length[which][:, None], 1, 0)
            at = start[which][:, None] + column[None, :]
            live = np.arange(len(which))
            while len(live):
                s, a = size[live], at[live]
                both = s[:, :-1] + s[:, 1:]
                possible = (s[:, 1:] > 0) & (both <= p.longest)
                score = np.where(possible, p.score[table[np.minimum(a[:, :-1], len(table) - 1), np.minimum(both, p.longest)]], -np.inf)
                best = score.argmax(axis=1) if score.shape[1] else np.zeros(len(live), np.int64)
                rows = np.flatnonzero(score[np.arange(len(live)), best] > -np.inf) if score.shape[1] else np.zeros(0, np.int64)
                live, best, s, a = live[rows], best[rows], s[rows], a[rows]
                if not len(live):
                    break
                s[np.arange(len(live)), best] = both[rows, best]
                shift = np.minimum(column[None, :] + (column[None, :] > best[:, None]), width - 1)
                end = (column[None, :] > best[:, None]) & (column[None, :] + 1 >= width)
                size[live] = np.where(end, 0, np.take_along_axis(s, shift, 1))
                at[live] = np.take_along_axis(a, shift, 1)
            some = size > 0
            symbols[at[some]] = size[some]

    def _agenda(self, table: np.ndarray, start: int, n: int, symbols: np.ndarray) -> None:
        """Relax one long cut with a queue of the edges that join neighbours: the best-ranked, then leftmost, first.

        A queued edge is one number, rank then place then length, and symbols
        are arrays, so that a cut of a million characters stays small.
        """
        p, at, item = self.pieces, start, table.item
        rank, longest = p.rank.tolist(), p.longest
        size, before = array("i", [1]) * n, array("q", range(-1, n - 1))

        def edge(i: int) -> int:
            j = i + size[i]
            if j < n and (k := size[i] + size[j]) <= longest and (piece := item(at + i, k)) >= 0:
                return rank[piece] << 48 | i << 8 | k
            return -1

        queue = [e for i in range(n - 1) if (e := edge(i)) >= 0]
        heapq.heapify(queue)
        while queue:
            e = heapq.heappop(queue)
            i, k = e >> 8 & (1 << 40) - 1, e & 255
            j = i + size[i] if size[i] else n
            if not size[i] or j >= n or size[i] + size[j] != k:
                continue
            size[i], size[j] = k, 0
            if i + k < n:
                before[i + k] = i
            for left in (i, before[i]):
                if left >= 0 and (e := edge(left)) >= 0:
                    heapq.heappush(queue, e)
        symbols[start : start + n] = size

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, as little-endian 32-bit integers."""
        cut = [self.cuts(t) if t else [] for t in texts]
        out, waiting, new = [], [], set()
        for c in cut:
            new.update(c)
            waiting.append(c)
            if len(new) > REMEMBERED // 4:
                self.learn(new)
                out += [b"".join(map(self.known.__getitem__, w)) for w in waiting]
                waiting, new = [], set()
        self.learn(new)
        return out + [b"".join(map(self.known.__getitem__, w)) for w in waiting]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids as the library gives it: byte pieces by runs, bad bytes as replacement characters."""
        p = self.pieces
        parts = list(map(p.text.__getitem__, ids.tolist()))
        at = np.flatnonzero(np.isin(ids, self._byte_ids)).tolist()
        i = 0
        while i < len(at):
            j = i
            while j + 1 < len(at) and at[j + 1] == at[j] + 1:
                j += 1
            raw = bytes(p.byte_of[int(ids[k])] for k in at[i : j + 1])
            parts[at[i]] = _decoded(raw)
            i = j + 1
        text = "".join(parts)
        if p.prefix and text.startswith(SPACE) and ids[0] not in p.byte_of:
            text = text[1:]
        return text.replace(SPACE, " ")

    @functools.cached_property
    def _byte_ids(self) -> np.ndarray:
        return np.array(sorted(self.pieces.byte_of))


def _decoded(raw: bytes) -> str:
    """Every byte that is no part of a whole character becomes a replacement character of its own."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode("utf-8"))
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    out = arrow_schema(doc_id=pa.int64(), ids=pa.list_(pa.int32()))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            raw = c.encode(b["text"].to_pylist())
            values = np.frombuffer(b"".join(raw), "<i4")
            offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            yield batch_of(out, b["doc_id"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))

    return arrow_map(id_and_text(docs), encoded, "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of every array of ids; null arrays decode to the empty string."""
    out = arrow_schema(doc_id=pa.int64(), text=pa.string())

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            yield batch_of(out, b["doc_id"], [c.decode(np.array(x, np.int64)) if x else "" for x in b["ids"].to_pylist()])

    return arrow_map(ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")), decoded,
        "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids_crc32, decoded_equal[, ids]): encoded, decoded and compared in one pass over the texts."""
    fields = {"doc_id": pa.int64(), "n_pieces": pa.int64(), "n_byte_pieces": pa.int64(), "ids_crc32": pa.int64(),
        "decoded_equal": pa.bool_()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
    out = arrow_schema(**fields)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            texts = b["text"].to_pylist()
            raw = c.encode(texts)
            rows = []
            for text, r in zip(texts, raw, strict=True):
                ids = np.frombuffer(r, "<i4")
                rows.append((len(ids), int(np.isin(ids, c._byte_ids).sum()), zlib.crc32(r), c.decode(ids) == (text or "")))
            columns = [b["doc_id"], *([list(x) for x in zip(*rows, strict=True)] or [[]] * 4)]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), "<i4"))))
            yield batch_of(out, *columns)

    names = {"doc_id": "long", "n_pieces": "long", "n_byte_pieces": "long", "ids_crc32": "long", "decoded_equal": "boolean", "ids": "array<int>"}
    return arrow_map(id_and_text(docs), coded, ", ".join(f"{k} {names[k]}" for k in fields))
