"""SentencePiece encoding with seeded merge-dropout, and decoding. [operator 5]

A text becomes the characters of its chunks; a chunk is a word with the blanks in
front of it, and no piece reaches over its end. Each chunk has an agenda of
candidate merges, two neighbours whose joined text is a piece. The best candidate is
taken until none is left. A candidate is skipped for good when a hash of its place,
keyed by seed, document, copy and the chunk's number in its text, falls below
``dropout``: so every occurrence of a word is cut on its own, always by merges the
model knows, and always decodes to what it was. Characters that the model lacks become
byte pieces. With no dropout the result is the model's own segmentation.

The vocabulary is read from a file whose path is a parameter; it is small and fixed,
and sent to the tasks. A task remembers each chunk as it is cut without a skip, and the
candidates that this takes; an occurrence that skips none of these is cut so, as the ones
it may skip would never have been the best. Any other goes through its own agenda, all of
a batch as arrays. What is remembered changes no result.

Cases: null text gives null ids, null ids give null text; an empty text gives no
ids. The character that marks blanks in the vocabulary is kept as bytes where a text
holds it. Rows of one id that follow each other in a partition are copies 0, 1, 2, ...
and are cut as such; copies further apart, or in other partitions, start at 0 again.
Rows without an id share a key. An empty table gives an empty result. Further columns
stay as they are; ``out`` names the new one.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import give_back, ship

DROPOUT = 0.1
MARK = "▁"
# Stands for the mark itself in a text; a lone surrogate cannot come from UTF-8.
MARK_IN_TEXT = "\udc81"
CHUNKS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
LONG = 32
NONE = 1 << 30
MEMORY = 500_000
SLICE_BYTES = 1 << 20
# Occurrences that are held against their candidates together, chunks merged together.
BLOCK, ROWS = 50_000, 5_000


class Vocabulary:
    """Pieces, their ranks, and which two pieces join into which."""

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        plain, byte, unknown = 1, 6, 2
        self.size = len(model.pieces)
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == plain}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        texts = [b""] * self.size
        for i, p in enumerate(model.pieces):
            if p.type == byte:
                code = int(p.piece[3:5], 16)
                self.byte_ids[code] = i
                texts[i] = bytes([code])
            elif p.type == plain:
                texts[i] = p.piece.replace(MARK, " ").encode()
            elif p.type == unknown:
                texts[i] = b"\xef\xbf\xbd"
        self.text = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.text_size = np.array([len(t) for t in texts], dtype=np.int64)
        self.text_start = np.concatenate([[0], np.cumsum(self.text_size)[:-1]])
        self.char_id = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        # Rank 0 is the best score; equal scores share a rank.
        scores = np.array([-p.score for p in model.pieces])
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int32)
        self.rank_or_none = np.append(self.rank, np.int32(NONE))  # of piece -1, the last one
        pairs = {}
        for piece, i in ids.items():
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = i
        keys = np.array(sorted(pairs), dtype=np.int64)
        self._place(keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int32))

    def _place(self, keys, values) -> None:
        """Open addressing with room for eight times the pairs."""
        import numpy as np

        bits = max(4, int(8 * max(1, len(keys)) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, dtype=np.int64)
        self.merged = np.full((1 << bits) + 64, -1, dtype=np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            first = np.zeros(len(keys), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.merged[at[put]] = keys[put], values[put]
            keys, values, at = keys[~put], values[~put], at[~put] + 1
        self.probes = 1
        stored = np.flatnonzero(self.keys >= 0)
        if len(stored):
            self.probes = int((stored - self._slot(self.keys[stored])).max()) + 1

    def _slot(self, keys):
        import numpy as np

        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def join(self, left, right):
        """The piece that two pieces join into, -1 where there is none."""
        import numpy as np

        out = np.full(left.shape, -1, dtype=np.int32)
        key = left.astype(np.int64) * self.size + right
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        key = key[open_]
        at = self._slot(key)
        for _ in range(self.probes):
            found = self.keys[at]
            hit = found == key
            out[open_[hit]] = self.merged[at[hit]]
            more = ~hit & (found != -1)
            open_, key, at = open_[more], key[more], at[more] + 1
            if not len(open_):
                break
        return out


def _mixed(x):
    """A 64-bit finaliser: every bit of ``x`` moves every bit of the result."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(left, middle, end):
    """A candidate [left, middle) + [middle, end) as one number."""
    import numpy as np

    return (left.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)


def _skipped(key, left, middle, end, dropout: float):
    """Whether the candidate [left, middle) + [middle, end) of a keyed chunk is skipped."""
    return _skipped_at(key, _place(left, middle, end), dropout)


def _skipped_at(key, place, dropout: float):
    import numpy as np

    return (_mixed(_mixed(key ^ place) + place) >> np.uint64(11)) < np.uint64(int(dropout * (1 << 53)))


class Encoder:
    """Segments chunks under a seed and a dropout, and remembers what it segmented."""

    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int):
        self.vocabulary, self.dropout, self.seed = vocabulary, dropout, seed
        self.forget()

    def forget(self) -> None:
        """Known chunks, as they are cut without a skip."""
        import numpy as np

        self.known = _Numbered(self)
        self.pending: list[str] = []
        self.n = 0
        self.size, self.start = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)
        self.names: list[str] = []
        # How many candidates each takes, -1 where that is not known, and their places.
        self.taken, self.taken_start = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.places = np.zeros(0, dtype=np.uint64)

    def encode(self, texts: list[str | None], keys: list[int]):
        """Flat ids of all texts, and how many each text has; 0 for null.

        Texts of one key are cut alike where they are alike.
        """
        import numpy as np

        if self.n > MEMORY:
            self.forget()
        codes, per_text = [], []
        for text in texts:
            chunks = CHUNKS.findall(MARK + text.replace(MARK, MARK_IN_TEXT).replace(" ", MARK)) if text else ()
            codes.append(np.fromiter(map(self.known.__getitem__, chunks), dtype=np.int64, count=len(chunks)))
            per_text.append(len(chunks))
        if self.pending:
            self._grow(self.pending)
            self.pending = []
        if not codes:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        codes, per_text = np.concatenate(codes), np.array(per_text, dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(per_text)])
        flat, starts, sizes = self.flat, self.start[codes], self.size[codes]
        if self.dropout > 0:
            number = (np.arange(len(codes)) - np.repeat(at[:-1], per_text)).astype(np.uint64)
            own = np.repeat(np.array(keys, dtype=np.int64).astype(np.uint64), per_text)
            seed = np.uint64(self.seed & (1 << 63) - 1)
            own = _mixed(own ^ _mixed(number * np.uint64(0xD1B54A32D192ED03) + seed))
            apart = self._apart(codes, own)
            if len(apart):
                more, own_flat = self.segment([(k, self.names[c]) for k, c in zip(own[apart].tolist(), codes[apart].tolist())])
                starts[apart] = len(self.flat) + np.cumsum(more) - more
                sizes[apart] = more
                flat = np.concatenate([self.flat, own_flat])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return gather(flat, starts, sizes), ends[at[1:]] - ends[at[:-1]]

    def _apart(self, codes, keys):
        """The occurrences that skip a candidate of those taken, or may: those need an agenda of their own."""
        import numpy as np

        out = self.taken[codes] < 0
        for i in range(0, len(codes), BLOCK):
            some = i + np.flatnonzero(self.taken[codes[i:i + BLOCK]] > 0)
            if len(some):
                counts = self.taken[codes[some]]
                before = np.cumsum(counts) - counts
                entry = np.arange(int(counts.sum())) + np.repeat(self.taken_start[codes[some]] - before, counts)
                lost = _skipped_at(np.repeat(keys[some], counts), self.places[entry], self.dropout)
                out[some] = np.logical_or.reduceat(lost, before)
        return np.flatnonzero(out)

    def _grow(self, chunks: list[str]) -> None:
        """Remember ``chunks``; long ones always have an agenda of their own."""
        import numpy as np

        short = np.array([self.dropout == 0 or len(c) <= LONG for c in chunks])
        some = np.flatnonzero(short)
        trace = None if self.dropout == 0 else []
        sizes, flat = np.zeros(len(chunks), dtype=np.int64), np.zeros(0, dtype=np.int32)
        taken, places = np.where(short, 0, -1), np.zeros(0, dtype=np.uint64)
        if len(some):
            sizes[some], flat = self._cut([chunks[i] for i in some.tolist()], np.zeros(len(some), dtype=np.uint64), trace)
        if trace:
            rows, places = map(np.concatenate, zip(*trace))
            places = places[np.argsort(rows, kind="stable")]
            taken[some] = np.bincount(rows, minlength=len(some))
        join = np.concatenate
        self.names += chunks
        self.start = join([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size, self.flat = join([self.size, sizes]), join([self.flat, flat])
        counts = np.maximum(taken, 0)
        self.taken_start = join([self.taken_start, len(self.places) + np.cumsum(counts) - counts])
        self.taken, self.places = join([self.taken, taken]), join([self.places, places])

    def segment(self, chunks: list[tuple[int, str]]):
        """Sizes and flat ids of ``(key, chunk)``, in their order."""
        import numpy as np

        return self._cut([c for _, c in chunks], np.array([k for k, _ in chunks], dtype=np.uint64))

    def _cut(self, chunks: list[str], keys, trace: list | None = None):
        """Sizes and flat ids of chunks under their keys.

        With ``trace`` nothing is skipped, and it gets the (row, place) of every candidate taken.
        """
        import numpy as np

        v = self.vocabulary
        lengths = np.array([len(c) for c in chunks], dtype=np.int64)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        ids = v.char_id[codes]
        out_piece, out_row, out_at = [], [], []
        edges = (4, 7, 10, 14, 20, LONG)
        for low, high in zip((0, *edges), edges):
            for rows in np.array_split(r := np.flatnonzero((lengths > low) & (lengths <= high)), max(1, len(r) // ROWS)):
                if len(rows):
                    if trace is None:
                        piece, row, at = self._merge(ids, starts[rows], lengths[rows], keys[rows], high)
                    else:
                        own: list = []
                        piece, row, at = self._merge(ids, starts[rows], lengths[rows], keys[rows], high, own)
                        trace += [(rows[r], place) for r, place in own]
                    out_piece.append(piece), out_row.append(rows[row]), out_at.append(at)
        for r in np.flatnonzero(lengths > LONG):
            piece, at = self._merge_long(ids[starts[r]:starts[r] + lengths[r]], keys[r])
            out_piece.append(piece), out_row.append(np.full(len(piece), r)), out_at.append(at)
        piece, row, at = map(np.concatenate, (out_piece, out_row, out_at))
        order = np.argsort(starts[row] + at, kind="stable")
        piece, row, at = piece[order], row[order], at[order]
        # Characters that the model lacks become their bytes.
        lost = np.flatnonzero(piece < 0)
        if not len(lost):
            return np.bincount(row, minlength=len(chunks)), piece.astype(np.int32)
        count = np.ones(len(piece), dtype=np.int64)
        raw = [chr(c).replace(MARK_IN_TEXT, MARK).encode() for c in codes[starts[row[lost]] + at[lost]].tolist()]
        count[lost] = [len(b) for b in raw]
        flat = np.repeat(piece, count).astype(np.int32)
        flat[flat < 0] = v.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return np.bincount(np.repeat(row, count), minlength=len(chunks)), flat

    def _merge(self, ids, starts, lengths, keys, width: int, trace: list | None = None):
        """The agendas of many short chunks, one merge of each at a time."""
        import numpy as np

        n, columns = len(starts), np.arange(width)
        real = columns < lengths[:, None]
        piece = np.where(real, ids[np.minimum(starts[:, None] + columns, len(ids) - 1)], -2).astype(np.int32)
        # Where each symbol starts; behind the last one, where the chunk ends.
        begin = np.minimum(np.arange(width + 1), lengths[:, None]).astype(np.int16)
        if width == 1:
            return piece[:, 0], np.arange(n), begin[:, 0]
        rank_or_none, join = self.vocabulary.rank_or_none, self.vocabulary.join
        rank = rank_or_none[self._candidates(piece[:, :-1], piece[:, 1:], keys[:, None], begin[:, :-2], begin[:, 1:-1],
                                             begin[:, 2:], trace is None)]
        done, live = [], np.arange(n)
        while len(live):
            rows = np.arange(len(live))
            best = rank.argmin(axis=1)
            more = rank[rows, best] < NONE
            if not more.all():
                row, at = np.nonzero(piece[~more] != -2)
                done.append((piece[~more][row, at], live[~more][row], begin[~more][row, at]))
                piece, begin, rank, best, live, keys = (x[more] for x in (piece, begin, rank, best, live, keys))
                rows = np.arange(len(live))
            if trace is not None:
                trace.append((live, _place(*(begin[rows, best + i] for i in range(3)))))
            piece[rows, best] = join(piece[rows, best], piece[rows, best + 1])
            # What stands behind the merge moves up by one, so each round needs a column less.
            width -= 1
            after = columns[:width + 1] > best[:, None]
            piece = np.where(after[:, :width], piece[:, 1:], piece[:, :-1])
            begin = np.where(after, begin[:, 1:], begin[:, :-1])
            if width == 1:
                done.append((piece[:, 0], live, begin[:, 0]))
                break
            rank = np.where(after[:, :width - 1], rank[:, 1:], rank[:, :-1])
            for at in (best - 1, best):
                here = np.flatnonzero((at >= 0) & (at < width - 1))
                k = at[here]
                rank[here, k] = rank_or_none[self._candidates(
                    piece[here, k], piece[here, k + 1], keys[here],
                    begin[here, k], begin[here, k + 1], begin[here, k + 2], trace is None)]
        return tuple(map(np.concatenate, zip(*done)))

    def _candidates(self, left, right, key, a, b, c, skip: bool = True):
        """What two neighbours join into, -1 where they do not or, with ``skip``, the merge is skipped."""
        import numpy as np

        flat = self.vocabulary.join(left.ravel(), right.ravel())
        if self.dropout > 0 and skip:
            at = np.flatnonzero(flat >= 0)
            key, a, b, c = (np.broadcast_to(x, left.shape).ravel()[at] for x in (key, a, b, c))
            flat[at[_skipped_at(key, _place(a, b, c), self.dropout)]] = -1
        return flat.reshape(left.shape)

    def _merge_long(self, ids, key):
        """The agenda of one long chunk, as a heap."""
        import numpy as np

        n = len(ids)
        piece, nxt, prev = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        end, agenda = list(range(1, n + 1)), []
        alive = [True] * n

        def offer(pairs):
            if not pairs:
                return
            a, b = np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])
            ends = np.array([end[q] for _, q in pairs])
            found = self._candidates(np.array([piece[p] for p in a]), np.array([piece[q] for q in b]),
                                     np.full(len(a), key), a, b, ends)
            for p, q, e, m in zip(a.tolist(), b.tolist(), ends.tolist(), found.tolist()):
                if m >= 0:
                    heapq.heappush(agenda, (int(self.vocabulary.rank[m]), p, q, e, m))

        offer([(i, i + 1) for i in range(n - 1)])
        while agenda:
            _, p, q, e, m = heapq.heappop(agenda)
            if not (alive[p] and alive[q] and nxt[p] == q and end[q] == e and end[p] == q):
                continue
            piece[p], end[p], nxt[p], alive[q] = m, e, nxt[q], False
            if nxt[p] < n:
                prev[nxt[p]] = p
            offer([(x, y) for x, y in ((prev[p], p), (p, nxt[p])) if x >= 0 and y < n])
        at = [i for i in range(n) if alive[i]]
        return np.array([piece[i] for i in at]), np.array(at)


class _Numbered(dict):
    """Numbers of chunks; an unseen chunk gets the next one and is put down to be cut."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> int:
        e = self.encoder
        e.pending.append(chunk)
        self[chunk] = at = e.n
        e.n += 1
        return at


def gather(flat, starts, sizes):
    """The runs ``flat[start:start + size]``, one behind the other."""
    import numpy as np

    before = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    return flat[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


def _slices(batch, column: str) -> Iterator:
    """Pieces of a batch with a few MB in ``column``, one row at least."""
    step = max(1, int(batch.num_rows * SLICE_BYTES / max(SLICE_BYTES, batch.column(column).nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
           out: str = "ids", dropout: float = DROPOUT, seed: int = 1,
           check: bool = False) -> DataFrame:
    """``docs`` with the piece ids of ``text`` as ``out``.

    With ``check`` the task decodes them again at once, and the job stops at a text that
    its ids do not decode to.
    """
    if not 0 <= dropout <= 1:
        raise ValueError("dropout is a share")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    key = "_key"
    while key in docs.columns:
        key += "_"
    rows = docs.withColumn(key, F.xxhash64(F.lit(seed), doc_id))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    names = docs.columns

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = Encoder(shared.value, dropout, seed)
        last, copy = None, 0
        for whole in batches:
            for batch in _slices(whole, text):
                texts, keys = batch.column(text).to_pylist(), batch.column(key).to_pylist()
                for i, k in enumerate(keys):
                    copy = copy + 1 if k == last else 0
                    last, keys[i] = k, k ^ copy << 32
                flat, sizes = encoder.encode(texts, keys)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                null = pa.array([t is None for t in texts] + [False])
                ends = pa.array(offsets, mask=null.to_numpy(zero_copy_only=False))
                ids = pa.ListArray.from_arrays(ends, pa.array(flat, type=pa.int32()))
                if check and decode_lists(shared.value, ids).to_pylist() != texts:
                    raise ValueError("ids do not decode to the text")
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids], [*names, out])
        del encoder
        give_back()

    return rows.mapInArrow(work, schema)


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` as ``out``; bytes that are no UTF-8 are replaced."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())])
    names = docs.columns

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in _slices(whole, ids):
                texts = decode_lists(shared.value, batch.column(ids))
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, out])
        give_back()

    return docs.mapInArrow(work, schema)


def decode_lists(v: Vocabulary, lists):
    """Arrow strings of an Arrow array of id lists."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    data = gather(v.text, v.text_start[flat], v.text_size[flat])
    ends = np.concatenate([[0], np.cumsum(v.text_size[flat])])
    at = np.concatenate([[0], np.cumsum(sizes)])
    starts, stops = ends[at[:-1]], ends[at[1:]]
    # The blank that encoding put in front of every text.
    lead = (stops > starts) & (np.append(data, 0)[np.minimum(starts, len(data))] == 32)
    keep = np.ones(len(data), dtype=bool)
    keep[starts[lead]] = False
    offsets = np.concatenate([[0], np.cumsum(stops - starts - lead)]).astype(np.int32)
    raw = data[keep].tobytes()
    nulls = lists.is_null().to_numpy(zero_copy_only=False)
    try:
        raw.decode()
        texts = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
    except UnicodeDecodeError:
        texts = pa.array([raw[a:b].decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:])], type=pa.string())
    return pc.if_else(pa.array(nulls), pa.scalar(None, pa.string()), texts) if nulls.any() else texts


def checked(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` as they are; the job stops at a text that its ids do not decode to."""
    decoded = "_decoded"
    while decoded in docs.columns:
        decoded += "_"
    back = decode(docs, vocabulary, ids, decoded)
    same = F.col(decoded).eqNullSafe(F.col(text))
    broken = F.raise_error(F.lit("ids do not decode to the text")).cast(docs.schema[ids].dataType)
    return back.withColumn(ids, F.when(same, F.col(ids)).otherwise(broken)).drop(decoded)
