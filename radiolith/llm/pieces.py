"""SentencePiece encoding and decoding by suffix-array matching.

A batch's texts are cut where no piece of the vocabulary can reach across (before a space mark, and around characters that
no piece has), and each distinct segment is encoded once:

1. The segments are joined to one text, whose suffixes are sorted by as many characters as the longest piece has.
2. Every piece is looked up by binary search: the suffixes that start with it are one range, its occurrences.
3. Occurrences are edges from their start to their end. Sorted by their end's distance from the segment's start, those of
   one distance are relaxed together, in all segments at once, from left to right.

In a byte-pair model the best path is not the one of least cost but the one that merging gives. A path is that of the
merges exactly if every two neighbouring pieces, joined and merged alone, come apart again at the same place. So an edge is
relaxed if its piece stands that test with the last piece of the path at its start; one edge per position does.

Characters without a piece become the pieces of their UTF-8 bytes, or the unknown piece in a model without those. The model
file is read on the driver and broadcast (its size does not depend on the data); it is never trained here.

Defined cases: a null or empty text has no pieces; the space mark U+2581 in a text is a space to the model and decodes to
one; repeated rows are encoded alike; null ids pass through; an empty table gives no rows; very long texts are read whole;
columns other than id and text are not read by ``encode``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Where the public tokenizer files are; see encode's ``model_path``.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_CHUNK = 150_000
_CACHED = 150_000
#: Places of pairs whose agreement is kept in arrays, and the odd number that scatters them.
_PLACES, _SCATTER = 1 << 20, np.uint64(0x9E3779B97F4A7C15)
_NONE = 1 << 40
#: Characters of a segment that advances in lockstep with others, at most.
_LOCKSTEP = 256


class Codec:
    """A byte-pair model's vocabulary, with its encoder and decoder."""

    def __init__(self, model: bytes):
        self.model = model
        self._load()

    def __reduce__(self):
        return Codec, (self.model,)

    def _load(self) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.ids, self.scores, self.bytes = {}, {}, {}
        self.texts: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.texts.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unused(i):
                self.texts.append(b"")
            elif sp.is_unknown(i):
                self.texts.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
                self.texts.append(piece.replace(MARK, " ").encode())
        self.unknown = sp.unk_id()
        self.prefix = MARK if sp.encode("a", out_type=str)[0].startswith(MARK) else ""
        self.pieces = sorted(self.ids)
        self.longest = max(map(len, self.pieces))
        alphabet = sorted({c for p in self.pieces for c in p})
        # Codes from 2 on; 0 stands between segments, 1 for characters of no piece.
        self.codes = {c: k + 2 for k, c in enumerate(alphabet)}
        self.strings = {i: p for p, i in self.ids.items()}
        low = np.zeros((len(self.pieces), self.longest), ">u2")
        for row, piece in zip(low, self.pieces, strict=True):
            row[: len(piece)] = [self.codes[c] for c in piece]
        self.low, self.high = self._keys(low), self._keys(np.where(low == 0, 0xFFFF, low).astype(">u2"))
        self.piece_ids = np.array([self.ids[p] for p in self.pieces], np.int32)
        self.lengths = np.array([len(p) for p in self.pieces], np.int32)
        splits = all(MARK not in p.lstrip(MARK) for p in self.pieces)
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in self.codes)
        cut = MARK if splits else ""
        self.segment = re.compile(
            (f"{MARK}+[^{cut}{alone}]*|" if splits else "") + f"[^{cut}{alone}]+" + (f"|[{alone}]" if alone else "")
        ) if cut or alone else re.compile(r"(?s).+")
        self.code_of, self.is_piece = np.ones(0x110000, np.uint16), np.zeros(0x110000, bool)
        self.code_of[0], self.is_piece[0] = 0, True
        for c, code in self.codes.items():
            self.code_of[ord(c)], self.is_piece[ord(c)] = code, c in self.ids
        self.agree: dict[int, bool] = {}
        #: The pairs asked for lately, each at a place of its own number; another pair there is looked up in ``agree``.
        self.pair, self.apart = np.full(_PLACES, -1 << 63, np.int64), np.zeros(_PLACES, bool)
        self.fresh: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _keys(self, rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows).view(f"S{2 * self.longest}").ravel()

    def merge(self, text: str) -> list[str]:
        """The plain merging of a short string: best score first, then leftmost."""
        parts = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(parts) and (score := self.scores.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(heap, (-score, i, len(parts[i]), len(parts[after[i]])))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if len(parts[i]) != left or j >= len(parts) or len(parts[j]) != right or not left:
                continue
            parts[i] += parts[j]
            parts[j], after[i] = "", after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [p for p in parts if p]

    def _string(self, piece: int) -> str:
        return self.strings[piece] if piece >= 0 else chr(-piece - 1)

    def _agrees(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart; kept under one number, which is smaller than a pair."""
        if len(self.agree) > 400_000:
            self.agree.clear()
        a, b = self._string(left), self._string(right)
        known = self.agree[(left << 22) + right] = self.merge(a + b) == [a, b]
        return known

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends, starts and pieces of all occurrences in the joined text, sorted by end."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.code_of[points]
        padded = np.concatenate((codes, np.zeros(self.longest, ">u2"))).astype(">u2")
        keys = self._keys(np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(codes)])
        suffixes = np.argsort(keys, kind="stable").astype(np.int32)
        sorted_keys = keys[suffixes]
        first = np.searchsorted(sorted_keys, self.low, "left")
        count = np.searchsorted(sorted_keys, self.high, "right") - first
        del keys, sorted_keys
        which = np.repeat(np.arange(len(count), dtype=np.int32), count)
        place = np.arange(len(which), dtype=np.int32) + (first - np.cumsum(count) + count).astype(np.int32)[which]
        starts, pieces = suffixes[place], self.piece_ids[which]
        ends = starts + self.lengths[which]
        del which, place
        lone = np.flatnonzero(~self.is_piece[points]).astype(np.int32)
        starts = np.concatenate((starts, lone))
        ends = np.concatenate((ends, lone + 1))
        pieces = np.concatenate((pieces, -points[lone].astype(np.int32) - 1))
        order = np.argsort(ends, kind="stable")
        return ends[order], starts[order], pieces[order]

    def _stand(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two pieces stay apart."""
        keys = (left << 22) + right
        places = (keys.view(np.uint64) * _SCATTER >> np.uint64(64 - _PLACES.bit_length() + 1)).view(np.int64)
        out, met = self.apart[places], self.pair[places] == keys
        new = np.flatnonzero(~met)
        if len(new):
            distinct, first, which = np.unique(keys[new], return_index=True, return_inverse=True)
            agree, check, found = self.agree, self._agrees, []
            for key, at in zip(distinct.tolist(), new[first].tolist(), strict=True):
                known = agree.get(key)
                found.append(check(int(left[at]), int(right[at])) if known is None else known)
            found = np.array(found, bool)
            out[new] = found[which]
            self.pair[places[new]], self.apart[places[new]] = keys[new], out[new]
        return out

    def _relax_alone(self, starts: np.ndarray, ends: np.ndarray, pieces: np.ndarray, heads: np.ndarray, last: np.ndarray, back: np.ndarray) -> None:
        """Edges of long segments, sorted by end, one after the other: few segments make lockstep a loop over characters."""
        agree, check, own = self.agree, self._agrees, {}
        for start, end, piece, head in zip(starts.tolist(), ends.tolist(), pieces.tolist(), heads[starts].tolist(), strict=True):
            if start != head:
                before = own.get(start)
                if before is None:
                    continue
                known = agree.get((before << 22) + piece)
                if not (check(before, piece) if known is None else known):
                    continue
            own[end] = piece
            last[end], back[end] = piece, start

    def _relax(self, starts: np.ndarray, ends: np.ndarray, pieces: np.ndarray, heads: np.ndarray, widths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The last piece of the path to each position and where it starts. ``heads`` and ``widths`` have start and length
        of each position's segment.

        Segments advance in lockstep: edges that end at the same distance from their segment's start are relaxed
        together, as all that they lean on ends before.
        """
        last, back = np.full(size + 1, _NONE, np.int64), np.zeros(size + 1, np.int32)
        long = widths[starts] > _LOCKSTEP
        if long.any():
            self._relax_alone(starts[long], ends[long], pieces[long], heads, last, back)
            starts, ends, pieces = starts[~long], ends[~long], pieces[~long]
        steps = ends - heads[starts]
        order = np.argsort(steps, kind="stable")
        starts, ends, pieces, steps = starts[order], ends[order], pieces[order], steps[order]
        del order
        cuts = np.flatnonzero(np.diff(steps, prepend=0, append=1 << 30))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            start, end, piece = starts[a:b], ends[a:b], pieces[a:b].astype(np.int64)
            before = last[start]
            good = start == heads[start]
            asked = np.flatnonzero(~good & (before != _NONE))
            if len(asked):
                good[asked] = self._stand(before[asked], piece[asked])
            last[end[good]], back[end[good]] = piece[good], start[good]
        return last, back

    def _encode_segments(self, segments: list[str]) -> None:
        # A NUL in a text is a character of no piece, and so is its stand-in.
        joined = "\0".join(s.replace("\0", "\uffff") for s in segments) + "\0"
        ends, starts, pieces = self.edges(joined)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        firsts = np.cumsum(lengths + 1) - lengths - 1
        last, back = self._relax(starts, ends, pieces, np.repeat(firsts.astype(np.int32), lengths + 1), np.repeat(lengths.astype(np.int32), lengths + 1), len(joined))
        # All paths are followed back together, a piece at a time.
        here, active, rounds = firsts + lengths, np.flatnonzero(lengths), []
        while len(active):
            at = here[active]
            rounds.append((active, last[at], back[at]))
            here[active] = back[at]
            active = active[back[at] > firsts[active]]
        owner, found, places = (np.concatenate([r[k] for r in rounds]) if rounds else np.zeros(0, np.int64) for k in range(3))
        order = np.lexsort((places, owner))
        owner, found, places = owner[order], found[order], places[order]
        stops = np.searchsorted(owner, np.arange(len(segments)), "right")
        whole, start = found.astype(np.int32).tobytes(), 0
        special = set(owner[found < 0].tolist())
        for k, (segment, stop) in enumerate(zip(segments, stops.tolist(), strict=True)):
            if k in special:
                out, first = [], int(firsts[k])
                for piece, place in zip(found[start:stop].tolist(), places[start:stop].tolist(), strict=True):
                    if piece >= 0:
                        out.append(piece)
                    elif self.bytes:
                        out.extend(self.bytes[b] for b in segment[place - first].encode())
                    else:
                        out.append(self.unknown)
                self.fresh[segment] = np.array(out, np.int32).tobytes()
            else:
                self.fresh[segment] = whole[4 * start : 4 * stop]
            start = stop

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's piece ids as bytes of 32-bit numbers."""
        if len(self.fresh) > _CACHED:
            self.fresh, self.old = {}, self.fresh
        split = [self.segment.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        wanted, size, taken = [], 0, set()
        for segments in split:
            for s in segments:
                if s not in self.fresh and s not in taken:
                    if s in self.old:
                        self.fresh[s] = self.old[s]
                        continue
                    taken.add(s)
                    wanted.append(s)
                    size += len(s) + 1
                    if size > _CHUNK:
                        self._encode_segments(wanted)
                        wanted, size, taken = [], 0, set()
        if wanted:
            self._encode_segments(wanted)
        found = self.fresh
        return [b"".join([found[s] for s in segments]) for segments in split]

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.texts
        text = b"".join([table[i] for i in ids.tolist()])
        return text[1:] if self.prefix and text[:1] == b" " else text


_CODECS: dict[bytes, Codec] = {}


def _codec(model: bytes) -> Codec:
    """One per worker process, so that its caches outlive a batch."""
    key = hashlib.sha256(model).digest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _slices(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(documents: DataFrame, model_path: str = MODEL_PATH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``pieces`` (ids) and ``n_pieces``."""
    with open(model_path, "rb") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            at = 0
            for part in _slices(batch.column("text").to_pylist()):
                made = codec.encode_batch(part)
                sizes = np.array([len(m) // 4 for m in made], np.int64)
                values = pa.array(np.frombuffer(b"".join(made), np.int32))
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(part)), pa.ListArray.from_arrays(offsets, values), pa.array(sizes)],
                    names=["id", "pieces", "n_pieces"],
                )
                at += len(part)

    return rows.mapInArrow(run, f"id {kind}, pieces array<int>, n_pieces long").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str = MODEL_PATH, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """Per row: id and ``text``; a null list is an empty text."""
    with open(model_path, "rb") as file:
        sent = encoded.sparkSession.sparkContext.broadcast(file.read())
    rows = encoded.select(F.col(id_col).alias("id"), F.col(pieces_col).cast("array<int>").alias("pieces"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            lists = (np.asarray(p.values) if p.is_valid else np.zeros(0, np.int32) for p in batch.column("pieces"))
            texts = pa.array([codec.decode(p) for p in lists], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), texts], names=["id", "text"])

    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(documents: DataFrame, model_path: str = MODEL_PATH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row, encoded and decoded again: id, ``n_pieces, pieces_sha256`` (of little-endian 32-bit ids),
    ``decoded_sha256`` and ``exact``."""
    with open(model_path, "rb") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            at = 0
            for part in _slices(batch.column("text").to_pylist()):
                sizes, shas, decoded, exact = [], [], [], []
                for text, made in zip(part, codec.encode_batch(part), strict=True):
                    back = codec.decode(np.frombuffer(made, np.int32))
                    sizes.append(len(made) // 4)
                    shas.append(hashlib.sha256(made).hexdigest())
                    decoded.append(hashlib.sha256(back).hexdigest())
                    exact.append(back == text.replace(MARK, " ").encode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(part)), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                     pa.array(decoded, pa.string()), pa.array(exact, pa.bool_())],
                    names=["id", "n_pieces", "pieces_sha256", "decoded_sha256", "exact"],
                )
                at += len(part)

    return rows.mapInArrow(
        run, f"id {kind}, n_pieces long, pieces_sha256 string, decoded_sha256 string, exact boolean"
    ).withColumnRenamed("id", id_col)
