"""Best-fit packing into sequences of several permitted lengths.

Pieces are placed longest first into the open sequence with the least room that still
holds them. Where none does, one is opened: each permitted length is filled on trial with
the longest waiting pieces, and the one with the least cost for each token it would hold
is taken (a length costs its tokens and ``overhead``). At the end every sequence shrinks
to the least permitted length that holds it.

Rows are dealt by hash into shards of about ``SHARD`` rows, each packed by one task, so
no task grows with the table. Equal rows are counted first and dealt in lots of at most
``LOT``, so they spread over shards however often they repeat. The length of a text is its
words and one end mark; texts longer than the greatest length are cut into pieces before a
word, and the pieces of a text, end to end, are the text itself.

Defined results: NULL and empty texts are one piece of one token; rows with equal lengths
are placed by id; repeated rows are packed each; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import Words, slices

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 64
SHARD = 4000
LOT = 250
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _trial(length: int, first: int, waiting: dict[int, int], mask: int) -> int:
    """Tokens that a sequence would hold, filled with the longest waiting pieces after its first."""
    used, taken = first, {}
    while (room := length - used) > 0:
        open_ = mask & ((1 << (room + 1)) - 1)
        if not open_:
            break
        piece = open_.bit_length() - 1
        count = min(waiting[piece] - taken.get(piece, 0), room // piece)
        if count <= 0:
            mask ^= 1 << piece
            continue
        taken[piece] = taken.get(piece, 0) + count
        used += count * piece
    return used


def best_fit(sizes: list[int], lengths=LENGTHS, overhead: int = OVERHEAD):
    """Sequence, position and final length of each piece; ``sizes`` must fall and fit the greatest length."""
    lengths = sorted(lengths)
    waiting: dict[int, int] = {}
    for s in sizes:
        waiting[s] = waiting.get(s, 0) + 1
    mask = sum(1 << s for s in waiting)
    rooms: dict[int, list[int]] = {}
    room_mask, used, home, position = 0, [], [], []
    for size in sizes:
        waiting[size] -= 1
        if not waiting[size]:
            mask ^= 1 << size
        fits = room_mask >> size
        if fits:
            room = size + ((fits & -fits).bit_length() - 1)
            seq = rooms[room].pop()
            if not rooms[room]:
                room_mask ^= 1 << room
        else:
            seq = len(used)
            used.append(0)
            room = min((n for n in lengths if n >= size), key=lambda n: ((n + overhead) / _trial(n, size, waiting, mask), n))
        home.append(seq)
        position.append(used[seq])
        used[seq] += size
        if room > size:
            if not rooms.get(room - size):
                room_mask |= 1 << (room - size)
            rooms.setdefault(room - size, []).append(seq)
    final = [next(n for n in lengths if n >= u) for u in used]
    return home, position, [final[h] for h in home]


def _lengths(df: DataFrame, id_column: str, text: str, keep_text: bool) -> DataFrame:
    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                count = pa.array(np.diff(Words(part.column("text")).first) + 1, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), count, *([part.column("text")] if keep_text else [])], names=names)

    names = ["id", "n", *(["text"] if keep_text else [])]
    narrow = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text"))
    return narrow.mapInArrow(work, "id long, n long" + ", text string" * keep_text)


def _cut(text: str | None, greatest: int) -> list[str]:
    """The pieces of a text, each of ``greatest`` words but for the last, which the end mark follows."""
    raw = (text or "").encode()
    starts = [m.start() for m in WORD.finditer(raw)]
    edges = [0, *starts[greatest::greatest], len(raw)]
    pieces = [raw[a:b].decode() for a, b in zip(edges, edges[1:])]
    # Where the words fill the last piece, the end mark stands alone.
    return pieces + [""] * (len(starts) // greatest + 1 - len(pieces))


def _lots(df: DataFrame, shards: int) -> DataFrame:
    """Equal rows as lots of at most ``LOT``, each with its number of ``copies`` and its ``shard``."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    lots = counted.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / LOT))))
    copies = F.least(F.lit(LOT).cast("long"), F.col("copies") - F.col("lot") * LOT)
    return lots.withColumns({"copies": copies, "shard": F.pmod(F.xxhash64(*df.columns, "lot"), F.lit(shards))}).drop("lot")


def pack(df: DataFrame, id_column: str = "doc_id", text: str = "text", lengths=LENGTHS, overhead: int = OVERHEAD, with_text: bool = False) -> DataFrame:
    """One row for each piece: id, ``piece``, ``seq_id``, ``capacity``, ``position``, ``n_tokens`` and, if asked, its text."""
    shards = max(1, -(-df.count() // SHARD))
    greatest = max(lengths)

    def work(key, group):
        ids, n, copies = (group.column(c).to_pylist() for c in ("id", "n", "copies"))
        pieces = [(min(greatest, n[row] - at), ids[row], at // greatest, row) for row in range(len(ids)) for _ in range(copies[row]) for at in range(0, n[row], greatest)]
        if with_text:
            texts = group.column("text").to_pylist()
            pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], texts[p[3]] or ""))
        else:
            pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2]))
        home, position, capacity = best_fit([p[0] for p in pieces], lengths, overhead)
        base = key[0].as_py() << 32
        columns = [pa.array(c, t) for c, t in (
            ([p[1] for p in pieces], pa.int64()), ([p[2] for p in pieces], pa.int32()), ([base + h for h in home], pa.int64()),
            (capacity, pa.int32()), (position, pa.int32()), ([p[0] for p in pieces], pa.int32()))]
        if with_text:
            cut = [_cut(t, greatest) for t in texts]
            columns.append(pa.array([cut[p[3]][p[2]] for p in pieces], pa.string()))
        return pa.Table.from_arrays(columns, names=names)

    names = [id_column, "piece", "seq_id", "capacity", "position", "n_tokens", *(["text"] if with_text else [])]
    schema = f"`{id_column}` long, piece int, seq_id long, capacity int, position int, n_tokens int" + ", text string" * with_text
    return _lots(_lengths(df, id_column, text, with_text), shards).groupBy("shard").applyInArrow(work, schema)
