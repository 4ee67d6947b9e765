"""Best-fit packing of token pieces into sequences by swap-based local search.

Pieces shorter than a sequence are dealt into groups of a bounded number of
pieces by a hash of their row, so no key can make a group large. Each group is
packed on its own: best fit by decreasing length first, then a local search that
takes the emptiest sequence and moves its pieces out. A step is a move, a
two-for-one or a one-for-one exchange with another underfull sequence that is at
least as full; each step raises the sum of squared fills, and goes on until the
sequence is empty or no step is left, whatever the number of its pieces. A second
pass gathers what is left in the underfull sequences of all groups and packs that
anew, in groups again. A very long text is many pieces of full length, which are
sequences by themselves, and one shorter piece.
"""

from __future__ import annotations

import zlib
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import Staged, rows_of
from snapwise.llm.tokens import Encoder

#: Pieces packed together in one task.
GROUP = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, cut: str, size: int = 1024,
                 end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """The pieces of every whole text of ``docs`` (doc_id, text): its ids and an
    end id, cut into pieces of ``size`` ids if longer, of which the first may be
    shorter. Null text is an empty one. With ``with_ids`` the ids come along as
    little-endian unsigned 32-bit bytes."""
    def encode(batches):
        import pyarrow as pa
        encoder = Encoder.load(tokenizer, cut)
        end = end_id.to_bytes(4, "little")
        names = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
        schema = pa.schema(list(zip(names, types)))
        out: list[tuple] = []
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            ids = encoder.encode(text) + end
            n = len(ids) // 4
            at, piece = 0, 0
            to = n % size or size
            while at < n:
                data = ids[4 * at:4 * to] if n > size else ids
                length = len(data) // 4
                out.append((doc_id, piece, at, length, zlib.crc32(data), data)[:len(names)])
                at, to, piece = at + length, at + length + size, piece + 1
            if len(out) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(encode, PIECES + (", ids binary" if with_ids else ""))


def best_fit(lengths, size: int):
    """Bin of each length: best fit, longest first."""
    import numpy as np
    bins = np.empty(len(lengths), "int64")
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]  # by room left
    rooms, count = 0, 0  # bit r of rooms: some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b, count = size, count, count + 1
        bins[i] = b
        open_bins[room - need].append(b)
        rooms |= 1 << (room - need)
        if room == need:
            rooms &= ~1
    return bins


def two_of_each(pieces: list[int], size_of) -> list[int]:
    """Two pieces of each length at most: their pairs have all sums there are."""
    same: dict[int, list[int]] = {}
    for i in pieces:
        same.setdefault(int(size_of[i]), []).append(i)
    return [i for some in same.values() for i in some[:2]]


def best_exchange(given: dict[int, tuple], size_of, room):
    """The exchange that gains most for the taker: ``given`` holds what can be
    handed over by its length, ``size_of`` and ``room`` the pieces that can come
    back and the room left beside them. (gain, pieces given, piece back); the gain
    is 0 if there is none. Every length given is tried against every piece."""
    import numpy as np
    if not given or not len(size_of):
        return 0, (), -1
    sums = np.array(sorted(given))
    most = np.searchsorted(sums, size_of + room, "right") - 1
    gain = np.where((room > 0) & (most >= 0), sums[most] - size_of, 0)
    back = int(gain.argmax())
    return max(0, int(gain[back])), given[int(sums[most[back]])], back


def local_search(lengths, bins, size: int):
    """Improve a packing in place. Only underfull bins take part; a pass takes
    them from the emptiest, and passes go on while one takes a step: each raises
    the squared fill, so they end. Steps do not change the room in all; once that is
    less than a sequence, none can be emptied any more and no step is looked for."""
    import numpy as np
    n_bins = int(bins.max()) + 1 if len(bins) else 0
    fill = np.bincount(bins, lengths, n_bins).astype("int64")
    while True:
        steps = 0
        active = np.flatnonzero(fill[bins] < size)
        size_of, bin_of = lengths[active], bins[active].copy()
        for a in sorted(set(bin_of.tolist()), key=lambda b: (fill[b], b)):
            if size * np.count_nonzero((fill > 0) & (fill < size)) - fill[(fill > 0) & (fill < size)].sum() - (size - fill[a]) < fill[a]:
                break  # the others have too little room for it
            if fill[a] <= 0:
                continue
            mine = np.flatnonzero(bin_of == a).tolist()
            while mine:
                room = np.where((bin_of != a) & (fill[bin_of] >= fill[a]), size - fill[bin_of], 0)
                mine.sort(key=lambda i: -size_of[i])
                step = None
                for i in mine:  # move
                    left = room - size_of[i]
                    fits = np.flatnonzero(left >= 0)
                    if len(fits):
                        step = (left[fits].argmin(), fits, (i,), None)
                        break
                if step:
                    best, fits, out, back = step
                    b = int(bin_of[fits[best]])
                else:  # two for one, then one for one, by gain
                    pairs = {int(size_of[i] + size_of[j]): (i, j) for i, j in combinations(two_of_each(mine, size_of), 2)}
                    gain, out, back = best_exchange(pairs, size_of, room)
                    if not gain:
                        gain, out, back = best_exchange({int(size_of[i]): (i,) for i in mine}, size_of, room)
                    if not gain:
                        break
                    b = int(bin_of[back])
                moved = sum(int(size_of[i]) for i in out)
                for i in out:
                    bin_of[i] = b
                    mine.remove(i)
                if back is not None:
                    moved -= int(size_of[back])
                    bin_of[back] = a
                    mine.append(back)
                fill[a] -= moved
                fill[b] += moved
                steps += 1
        bins[active] = bin_of
        if not steps:
            return bins


def pack_lengths(lengths, size: int):
    """Bin of each length (1 to ``size``)."""
    import numpy as np
    lengths = np.asarray(lengths, "int64")
    return local_search(lengths, best_fit(lengths, size), size) if len(lengths) else np.zeros(0, "int64")


def _packed(df: DataFrame, size: int, keep_bins: bool) -> DataFrame:
    """Pack each group ``_sw_group`` of ``df``; adds the bin, the offset in it
    and its fill. With ``keep_bins`` the present bins (``_sw_bin``) are where
    the search starts, and stay if a fresh packing needs no fewer."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if not f.name.startswith("_sw_")]
    fields += ["_sw_group long", "_sw_bin long", "_sw_offset long", "_sw_fill long"]

    def pack(table):
        import numpy as np
        import pyarrow as pa
        lengths = table.column("length").to_numpy().astype("int64")
        # A group's rows may arrive in any order; the result must not change.
        order = np.argsort(table.column("_sw_row").to_numpy(), kind="stable")
        table, lengths = table.take(pa.array(order)), lengths[order]
        bins = pack_lengths(lengths, size)
        if keep_bins:
            _, old = np.unique(table.column("_sw_bin").to_numpy(), return_inverse=True)
            old = local_search(lengths, old.astype("int64"), size)
            if len(np.unique(old)) <= len(np.unique(bins)):
                bins = old
        _, bins = np.unique(bins, return_inverse=True)
        fill = np.bincount(bins, lengths).astype("int64")
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[by_bin])
        offset = np.empty(len(bins), "int64")
        offset[by_bin] = ends - lengths[by_bin] - (np.cumsum(fill) - fill)[bins[by_bin]]
        keep = [n for n in table.column_names if not n.startswith("_sw_")]
        group = table.column("_sw_group")[0].as_py()
        return pa.table({n: table.column(n) for n in keep} | {
            "_sw_group": np.full(len(bins), group), "_sw_bin": bins.astype("int64"),
            "_sw_offset": offset, "_sw_fill": fill[bins]})

    return df.groupBy("_sw_group").applyInArrow(pack, ", ".join(fields))


def _grouped(df: DataFrame, key) -> DataFrame:
    """Deal rows into groups of about ``GROUP`` by a hash of ``key``."""
    groups = max(1, -(-df.count() // GROUP))
    return df.withColumn("_sw_group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("long"))


def pack(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """Pack ``pieces`` (any columns, with ``length`` long from 1 to ``size``)
    into as few sequences as it can: the same rows and columns with sequence_id
    and offset. Repeated rows are packed as often as they stand; equal lengths
    are told apart by their row number; an empty table gives an empty one. A
    piece of full length is a sequence by itself."""
    names = pieces.columns
    rows = Staged(pieces.withColumn("_sw_row", F.monotonically_increasing_id()), "pieces").df
    whole = rows.filter(F.col("length") == size).select(
        *names, (F.col("_sw_row") * 3 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = rows.filter(F.col("length") < size)
    first = Staged(_packed(_grouped(short, "_sw_row"), size, False), "packed").df

    def placed(df: DataFrame, kind: int) -> DataFrame:
        number = F.col("_sw_group") * (GROUP * 64) + F.col("_sw_bin")
        return df.select(*names, (number * 3 + kind).alias("sequence_id"), F.col("_sw_offset").alias("offset"))

    full = first.filter(F.col("_sw_fill") == size)
    open_bins = first.filter(F.col("_sw_fill") < size).select(
        *names, F.monotonically_increasing_id().alias("_sw_row"),
        (F.col("_sw_group") * (GROUP * 64) + F.col("_sw_bin")).alias("_sw_bin"))
    again = _packed(_grouped(open_bins, "_sw_bin"), size, True)
    return whole.unionByName(placed(full, 0)).unionByName(placed(again, 1))


def pack_documents(docs: DataFrame, tokenizer: str, cut: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """Pack all of ``docs`` (doc_id, text; other columns are ignored): one row
    per piece with doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, tokenizer, cut, size, end_id), size)
