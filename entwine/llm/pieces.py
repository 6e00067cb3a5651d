"""SentencePiece encoding and decoding with a batched numpy Viterbi search.

A text becomes a word-start mark and its characters, spaces as that mark. It falls apart into words (a run of
marks and what follows it), over whose borders no piece of the model reaches. The distinct words of a chunk
are searched together, all of one length at once: the hashes of their substrings probe the sorted hashes of
the pieces, each step advances every word by a byte, and the best predecessor of each place is kept as a
backpointer. In a unigram model the best path is that of greatest summed piece score. In a BPE model scores
are merge ranks, whose sum means nothing: there a step between two pieces is open if merging by rank keeps
the border between them and closed otherwise. Such borders can be judged pair by pair, exactly one path is
open throughout, and it is the segmentation that merging by rank gives. A character without a piece goes byte
by byte; so does a literal mark, so that decoding gives back every text exactly.

A null or empty text has no ids; decoding no ids (or a null list) gives an empty text. Very long words are
searched whole. Ids that form no valid UTF-8 decode with replacement characters. Repeated texts are encoded
alike. All other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .common import give_back, held, mix, powers, string_chunks

MARK = "▁"
_MARK = MARK.encode()
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Stands for a space while words are found; no UTF-8 text has this byte.
_GAP = 0xFF
#: A character outside the model costs so much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Ids of words kept by a worker; when they are full, the cache starts anew.
_POOL, _SLOTS = 1 << 22, 20
#: Ids that are spelt out at once.
_IDS = 1 << 18
#: Words times places searched at once.
_CELLS = 1 << 18
#: Bytes of text that a worker takes from encoding to its output at once, and bytes of words it hashes at once.
SLICE_BYTES = 1 << 20

_mixed = mix(np.arange(256, dtype=np.uint64) + np.uint64(0xABCDEF))


def _key(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(total + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Pieces:
    """The model's tables: sorted hashes of its pieces with ids and scores, its byte ids, its spellings."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.size = n
        self.byte_ids = np.full(256, -1, np.int32)
        spelling, plain = [], []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                spelling.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelling.append(b"")
            else:
                spelling.append(piece.replace(MARK, " ").encode())
                plain.append((piece.encode().replace(_MARK, bytes([_GAP])), i, model.get_score(i)))
        if any(re.search(rb"[^\xff]\xff", p) for p, _, _ in plain):
            raise ValueError("a piece of this model reaches over the border of two words")
        if (self.byte_ids < 0).any():
            raise ValueError("this model has no byte pieces")
        self.longest = max(len(p) for p, _, _ in plain)
        flat = np.frombuffer(b"".join(p for p, _, _ in plain), np.uint8)
        size = np.array([len(p) for p, _, _ in plain])
        start = np.cumsum(size) - size
        hashes = _substrings(flat, start, start + size)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.ids = np.array([i for _, i, _ in plain], np.int32)[order]
        self.scores = np.array([s for _, _, s in plain])[order]
        self.unknown = float(self.scores.min()) - UNKNOWN_PENALTY
        self.text = np.frombuffer(b"".join(spelling), np.uint8)
        self.text_size = np.array([len(s) for s in spelling])
        self.text_start = np.cumsum(self.text_size) - self.text_size
        self.bpe = _kind(path) == "bpe"
        self.pair, self.stood = np.full(1 << _SLOTS, -1, np.int64), np.zeros(1 << _SLOTS, bool)
        if self.bpe:
            self._merges(plain)
        # a filter before the search: whether any piece has these low bits of a hash
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self._reset()

    def _reset(self) -> None:
        self.seen = np.zeros(1 << _SLOTS, np.uint64)
        self.at = np.zeros(1 << _SLOTS, np.int64)
        self.n = np.zeros(1 << _SLOTS, np.int32)
        self.pool = np.zeros(_POOL, np.int32)
        self.used = 0

    def _merges(self, plain: list[tuple[bytes, int, float]]) -> None:
        """Tables of merging by rank: each piece's rank (0: a character), and the two pieces it was last merged from."""
        rank = {p: r + 1 for r, (p, _, _) in enumerate(sorted(plain, key=lambda x: -x[2]))}
        ident = {p: i for p, i, _ in plain}
        n = self.size
        self.rank, self.left, self.right = np.zeros(n, np.int64), np.arange(n), np.arange(n)
        self.hash, self.bytes = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        flat, reachable = {}, np.zeros(n, bool)
        for piece, i, _ in plain:
            parts = [bytes(c) for c in re.findall(rb"[\x00-\x7f\xff]|[\xc0-\xfe][\x80-\xbf]*", piece)]
            flat[i], pair = piece, None
            while len(parts) > 1:
                best = min((rank.get(a + b, n + 1), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best[0] > n or (len(parts) == 2 and best[0] != rank[piece]):
                    break
                pair = parts[best[1] : best[1] + 2]
                parts[best[1] : best[1] + 2] = [b"".join(pair)]
            reachable[i] = parts == [piece]
            if pair and reachable[i] and all(x in ident for x in pair):
                self.rank[i], self.left[i], self.right[i] = rank[piece], ident[pair[0]], ident[pair[1]]
        up, _ = powers(self.longest * 2 + 1)
        for i, piece in flat.items():
            b = np.frombuffer(piece, np.uint8)
            self.hash[i], self.bytes[i] = (_mixed[b] * up[: len(b)]).sum(dtype=np.uint64), len(b)
        kept = reachable[self.ids]  # merging never makes the others
        self.keys, self.ids, self.scores = self.keys[kept], self.ids[kept], self.scores[kept]

    def _known(self, pairs: np.ndarray) -> np.ndarray:
        """_stands of pairs (a * size + b), of which those met before are remembered."""
        at = (mix(pairs.astype(np.uint64)) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        new = np.flatnonzero(self.pair[at] != pairs)
        out = self.stood[at]
        if len(new):
            one, back = np.unique(pairs[new], return_inverse=True)
            out[new] = self._stands(one // self.size, one % self.size)[back]
            self.pair[at[new]] = pairs[new]
            stays = new[self.pair[at[new]] == pairs[new]]
            self.stood[at[stays]] = out[stays]
        return out

    def _stands(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging by rank keeps the border between pieces a[i] and b[i]. What the two grow from is
        followed back, the later merge first: the border falls if the parts that meet at it would merge earlier."""
        up, _ = powers(self.longest * 2 + 1)
        out, at = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), np.iinfo(np.int64).max)  # only merges of a lower rank come before this
        while len(at):
            h = _key(self.hash[a] + self.hash[b] * up[self.bytes[a]], self.bytes[a] + self.bytes[b])
            where = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            made = np.where(self.keys[where] == h, self.rank[self.ids[where]], np.iinfo(np.int64).max)
            ra, rb = self.rank[a], self.rank[b]
            falls = made < limit
            out[at[falls]] = False
            on = ~falls & ((ra > 0) | (rb > 0))
            at, a, b, ra, rb, limit = (x[on] for x in (at, a, b, ra, rb, limit))
            # undo the later of the two merges; of equal ones the right piece's, which came last
            undo_a = ra > rb
            # a merge on the left at the rank itself comes first; one on the right waits for what lies before it
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    def _search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length (a row of bytes each), one word after another, and their numbers."""
        count, length = words.shape
        head = (words < 0x80) | (words >= 0xC0)  # a character, or a gap, begins
        cut = np.concatenate([head, np.ones((count, 1), bool)], axis=1)
        up, down = powers(length + 1)
        total = np.zeros((count, length + 1), np.uint64)
        np.cumsum(_mixed[words] * up[:length], axis=1, out=total[:, 1:])
        best = np.full((count, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((count, length + 1), np.int32)
        via = np.full((count, length + 1), -1, np.int32)
        alone = self._alone(total, down, cut)
        for end in range(1, length + 1):
            low = max(0, end - self.longest)
            h = _key((total[:, end, None] - total[:, low:end]) * down[low:end], np.broadcast_to(end - np.arange(low, end), (count, end - low)))
            row, k = np.nonzero(self.may[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] & cut[:, low:end] & cut[:, end, None])
            probe = h[row, k]
            where = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            hit = self.keys[where] == probe
            row, k, where = row[hit], k[hit], where[hit]
            value = np.full((count, end - low), -np.inf)
            if self.bpe:
                before = via[row, low + k]
                open_ = best[row, low + k] > -np.inf
                real = np.flatnonzero(open_ & (before >= 0))  # nothing, or a character of bytes, stands before the others
                open_[real] = self._known(before[real].astype(np.int64) * self.size + self.ids[where[real]])
                row, k, where = row[open_], k[open_], where[open_]
                value[row, k] = 0.0
            else:
                value[row, k] = best[row, low + k] + self.scores[where]
            chosen = np.full((count, end - low), -1, np.int32)
            chosen[row, k] = self.ids[where]
            if alone is not None:
                rows = np.flatnonzero(alone[:, end] >= 0)
                frm = alone[rows, end]
                value[rows, frm - low] = best[rows, frm] + (0.0 if self.bpe else self.unknown)
            pick = value.argmax(axis=1)
            every = np.arange(count)
            best[:, end] = value[every, pick]
            back[:, end] = low + pick
            via[:, end] = chosen[every, pick]
        # walk back: a slot for each byte is enough
        out = np.full((count, length), -1, np.int32)
        here = np.full(count, length)
        while True:
            live = np.flatnonzero(here > 0)
            if not len(live):
                break
            frm, piece = back[live, here[live]], via[live, here[live]]
            out[live[piece >= 0], frm[piece >= 0]] = piece[piece >= 0]
            for i in np.flatnonzero(piece < 0):
                w, a, b = live[i], frm[i], here[live[i]]
                raw = words[w, a:b]
                raw = np.frombuffer(b" ", np.uint8) if raw[0] == _GAP else raw
                out[w, a : a + len(raw)] = self.byte_ids[raw]
            here[live] = frm
        kept = out >= 0
        return out[kept], kept.sum(axis=1)

    def _alone(self, total: np.ndarray, down: np.ndarray, cut: np.ndarray) -> np.ndarray | None:
        """For each word and place, the start of the character that ends there if no piece spells it, else -1;
        None if pieces spell all characters."""
        row, at = np.nonzero(cut)
        same = np.flatnonzero(row[1:] == row[:-1])
        row, a, b = row[same], at[same], at[same + 1]
        h = _key((total[row, b] - total[row, a]) * down[a], b - a)
        lacks = np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)] != h)
        if not len(lacks):
            return None
        out = np.full(cut.shape, -1, np.int64)
        out[row[lacks], b[lacks]] = a[lacks]
        return out

    def _learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of these words are, and how many."""
        size = ends - starts
        if not len(size):
            return size, size
        at, n = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(size[order]) > 0, True])
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            length = int(size[order[a]])
            step = max(1, _CELLS // (length + 1) // min(length, self.longest))
            for i in range(a, b, step):
                group = order[i : min(i + step, b)]
                ids, count = self._search(buf[starts[group][:, None] + np.arange(length)])
                if self.used + len(ids) > len(self.pool):
                    self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.int32)])
                at[group], n[group] = self.used + np.cumsum(count) - count, count
                self.pool[self.used : self.used + len(ids)] = ids
                self.used += len(ids)
        return at, n

    def _ids_of(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words, one word after another, and their numbers; words met before are looked up."""
        if self.used > _POOL:
            self._reset()
        hashes = _substrings(buf, starts, ends)
        slot = (hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)
        at, n = self.at[slot], self.n[slot].astype(np.int64)
        new = np.flatnonzero(self.seen[slot] != hashes)
        uniq, one, back = np.unique(hashes[new], return_index=True, return_inverse=True)
        first_at, count = self._learn(buf, starts[new[one]], ends[new[one]])
        at[new], n[new] = first_at[back], count[back]
        slot = slot[new[one]]
        self.seen[slot] = uniq
        stays = self.seen[slot] == uniq  # of two new words in one place
        self.at[slot[stays]], self.n[slot[stays]] = first_at[stays], count[stays]
        begin = np.cumsum(n) - n
        return self.pool[np.arange(n.sum()) + np.repeat(at - begin, n)], n

    def encode(self, column: pa.Array) -> pa.Array:
        values, counts = [], []
        for first, last, raw, raw_offs in string_chunks(column, SLICE_BYTES):
            buf, offs = _marked(raw, raw_offs)
            starts, ends, row = _words(buf, offs)
            count, a = np.zeros(last - first), 0
            while a < len(starts):  # a very long text goes word group by word group
                b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLICE_BYTES, "right")))
                low = starts[a]
                ids, n = self._ids_of(buf[low : ends[b - 1]], starts[a:b] - low, ends[a:b] - low)
                values.append(ids)
                count += np.bincount(row[a:b], weights=n, minlength=last - first)
                a = b
            counts.append(count.astype(np.int64))
        size = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32)))

    def _spell(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of rows of ids, without the mark that every text got, and their offsets."""
        n = self.text_size[ids]
        begin = np.cumsum(n) - n
        data = self.text[np.arange(n.sum()) + np.repeat(self.text_start[ids] - begin, n)]
        edge = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(size)])]
        drop = edge[:-1][edge[1:] > edge[:-1]]
        drop = drop[data[drop] == 32]
        keep = np.ones(len(data), bool)
        keep[drop] = False
        return data[keep], np.concatenate([[0], np.cumsum(keep)])[edge]

    def decode(self, column: pa.Array) -> pa.Array:
        if column.null_count:
            column = pc.if_else(pc.is_null(column), pa.array([[]], pa.list_(pa.int32()))[0], column)
        size = pc.list_value_length(column).to_numpy().astype(np.int64)
        ids, offs = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)])
        data, edges, at = [], [np.zeros(1, np.int64)], 0
        while at < len(size):
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + _IDS, "right")) - 1)
            part, edge = self._spell(ids[offs[at] : offs[end]], size[at:end])
            data.append(part)
            edges.append(edges[-1][-1] + edge[1:])
            at = end
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate(edges)), pa.py_buffer(np.concatenate([np.zeros(0, np.uint8), *data]))])
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def _kind(path: str) -> str:
    """The kind of a model file: field 3 (model type) of its trainer message."""

    def fields(raw: bytes):
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                b = raw[at]
                at += 1
                value |= (b & 127) << shift
                shift += 7
                if b < 128:
                    return value

        while at < len(raw):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            elif tag & 7 == 2:
                n = number()
                at += n
                yield tag >> 3, raw[at - n : at]
            else:
                at += 4 if tag & 7 == 5 else 8

    with open(path, "rb") as f:
        trainer = next((v for k, v in fields(f.read()) if k == 2), b"")
    return {1: "unigram", 2: "bpe"}.get(next((v for k, v in fields(trainer) if k == 3), 1), "other")


def _substrings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_mixed[buf] * up[: len(buf)], out=total[1:])
    return _key((total[ends] - total[starts]) * down[starts], ends - starts)


def _marked(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a gap byte before their first character and for each space; a row without bytes stays so."""
    size = np.diff(offs)
    some = size > 0
    out = np.insert(buf, offs[:-1][some], 32) if some.any() else buf
    out = np.where(out == 32, _GAP, out).astype(np.uint8)
    return out, np.concatenate([[0], np.cumsum(size + some)])


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words: a run of gaps and the bytes up to the next."""
    gap = buf == _GAP
    first = gap.copy()
    first[1:] &= ~gap[:-1]
    first[offs[:-1][np.diff(offs) > 0]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(buf)) if len(starts) else starts, np.searchsorted(offs, starts, "right") - 1


def pieces(path: str) -> Pieces:
    """The tables of a model, for as long as a worker encodes or decodes."""
    return held(("pieces", path), lambda: Pieces(path))


def encode(text: Column, model: str = DEFAULT_MODEL) -> Column:
    """array<int>: the ids of each whole text. model: path that every worker can read."""

    @F.arrow_udf("array<int>")
    def run(x: pa.Array) -> pa.Array:
        return pieces(model).encode(x)

    return run(text)


def decode(ids: Column, model: str = DEFAULT_MODEL) -> Column:
    """The text of each list of ids."""

    @F.arrow_udf("string")
    def run(x: pa.Array) -> pa.Array:
        return pieces(model).decode(x)

    return run(ids)


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES of text (one longer row alone)."""
    for batch in batches:
        for first, last, *_ in string_chunks(batch.column(at), SLICE_BYTES):
            yield batch.slice(first, last - first)


def encoded(docs: DataFrame, text_col: str = "text", out: str = "ids", model: str = DEFAULT_MODEL) -> DataFrame:
    """docs with the ids of each whole text in a column `out`, which replaces one of that name. A worker holds the
    ids of one slice of a batch, not those of all its rows."""
    rest = docs.drop(out).withColumn(text_col, F.col(text_col).cast("string"))
    at = [c.lower() for c in rest.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        for part in _slices(batches, at):
            yield pa.RecordBatch.from_arrays([*part.columns, table.encode(part.column(at))], [*part.schema.names, out])
        give_back()

    return rest.mapInArrow(run, StructType([*rest.schema.fields, StructField(out, ArrayType(IntegerType()))]))


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """(id, ids, exact): the ids of each whole text, and whether decoding them gives that text (a null one: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        for part in _slices(batches, 1):
            text = pc.fill_null(part.column(1), "")
            ids = table.encode(text)
            yield pa.RecordBatch.from_arrays([part.column(0), ids, pc.equal(table.decode(ids), text.cast(pa.string()))], ["id", "ids", "exact"])
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>, exact boolean")
