"""Packing documents into fixed windows by minimum bin slack.

Texts become token ids, ids are cut into pieces of at most one window, and pieces shorter than a window are packed by
the minimum-bin-slack rule: the longest piece left opens a window, a bitset of reachable sums over the multiset of
remaining lengths finds the filling closest to capacity, and backtracking gives how many pieces of each length it
takes. A filling is repeated as often as the counts allow, so the work depends on the number of different lengths
and not on the number of pieces.

Pieces are dealt to shards of about ``shard_pieces`` by a hash of their row number, so neither a very long document
nor a repeated row can make a shard large. Only the last windows of a shard are filled badly.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

WINDOW = 1024
SHARD_PIECES = 20_000
LONG_BLANK = 10_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The filling ``{length: how many}`` of one window with least slack that holds the longest length left.

    ``counts`` holds the remaining number of pieces per length. Bit s of ``reach`` is set when a sum s can be made.
    """
    lengths = sorted((length for length, count in counts.items() if count), reverse=True)
    first, mask = lengths[0], (1 << (capacity + 1)) - 1
    reach, steps = 1 << first, []
    for length in lengths:
        most = min(counts[length] - (length == first), (capacity - first) // length)
        steps.append((length, reach))
        chunk = 1
        while most > 0:
            take = min(chunk, most)
            reach |= (reach << length * take) & mask
            most -= take
            chunk *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    filling = {first: 1}
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            filling[length] = filling.get(length, 0) + 1
    return filling


def fillings(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Windows for all pieces, as (filling, how often it is used)."""
    left, out = {length: count for length, count in counts.items() if count}, []
    while left:
        filling = fill_window(left, capacity)
        times = min(left[length] // number for length, number in filling.items())
        for length, number in filling.items():
            left[length] -= times * number
            if not left[length]:
                del left[length]
        out.append((filling, times))
    return out


def tokenize_pieces(docs: DataFrame, ranks_path: str, vocabulary_path: str, pattern: str, window: int = WINDOW,
                    end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) per piece of at most ``window`` ids.

    A document's ids are those of its whole text without special tokens, then ``end_id``; a null text is empty. The
    rank file holds the vocabulary of the vocabulary file and is several times as fast; a text that spells a special
    token goes through the vocabulary file, which knows it, and so does one with ``LONG_BLANK`` blanks of any kind in a
    row, for which the fast way's pattern would run out of stack (it takes 500,000).
    """
    def pieces(batches):
        import base64
        import re
        import zlib

        import pyarrow as pa
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        full = Tokenizer.from_file(vocabulary_path)
        special = [token.content for token in full.get_added_tokens_decoder().values()]

        long_blank = re.compile(rf"\s{{{LONG_BLANK}}}")

        def encode(text):
            if any(token in text for token in special) or len(text) >= LONG_BLANK and long_blank.search(text):
                return full.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        for batch in batches:
            columns = [[], [], [], [], []]
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            for at in range(batch.num_rows):
                ids = array("I", encode(texts[at].as_py() or ""))
                ids.append(end_id)
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    for column, value in zip(columns, (
                            doc_ids[at].as_py(), start, len(part), zlib.crc32(part.tobytes()), len(ids))):
                        column.append(value)
            yield pa.record_batch([pa.array(column, pa.int64()) for column in columns],
                                  names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, _PIECES)


def place_pieces(pieces: DataFrame, scratch: Scratch, window: int = WINDOW,
                 shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (gapless from 0 in its sequence) to pieces with a ``length``."""
    numbered = scratch.keep(pieces.withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-numbered.count() // shard_pieces))
    names = [name for name in numbered.columns if name != "row_no"]

    def pack(shard, rows):
        import numpy as np

        rows = rows.sort_values("row_no", kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        order = np.argsort(lengths, kind="stable")
        values, firsts, numbers = np.unique(lengths[order], return_index=True, return_counts=True)
        waiting = {int(v): iter(order[f:f + n].tolist()) for v, f, n in zip(values, firsts, numbers)}
        sequence, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        window_no = int(shard[0]) << 32
        for filling, times in fillings(dict(zip(values.tolist(), numbers.tolist())), window):
            for _ in range(times):
                used = 0
                for length, number in filling.items():
                    for _ in range(number):
                        row = next(waiting[length])
                        sequence[row], offset[row] = window_no, used
                        used += length
                window_no += 1
        return rows[names].assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"`{name}` {kind}" for name, kind in numbered.select(names).dtypes)
    return (
        numbered.withColumn("shard", F.pmod(F.xxhash64("row_no"), F.lit(shards)).cast("long"))
        .groupBy("shard").applyInPandas(pack, f"{schema}, sequence_id long, offset long")
    )


def pack_documents(docs: DataFrame, scratch: Scratch, ranks_path: str, vocabulary_path: str, pattern: str,
                   window: int = WINDOW) -> DataFrame:
    """All documents (doc_id, text) as pieces placed in sequences of at most ``window`` ids.

    Defined cases: a null or empty text is one piece of one id; a null doc_id stays null; repeated rows are packed
    once each; other columns are ignored; an empty table gives no rows. Ties between pieces of equal length go by
    row number.
    """
    return place_pieces(tokenize_pieces(docs, ranks_path, vocabulary_path, pattern, window), scratch, window)
