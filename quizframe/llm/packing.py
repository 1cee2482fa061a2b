"""Packing of tokenised documents into sequences: first-fit decreasing on a tournament tree.

* **Tokens.** Every whole text is tokenised with a public byte-level BPE file and closed
  by an end token; NULL counts as the empty text. A document is cut into pieces of a
  whole sequence, and a rest that is shorter.
* **Groups.** Pieces are dealt by a hash of their row's place into randomised groups of
  about ``GROUP_BYTES`` of text or ``GROUP_ROWS`` documents, whichever are fewer. The
  number of groups follows from the size of the table, so a group's memory does not grow
  with it; a place is drawn per row, so copies of one document spread over all groups,
  and so do the pieces of a long one. Each group is packed by itself, in one task.
* **First-fit decreasing.** Rests are taken from the longest to the shortest; each goes
  to the first sequence (bin) that has room. A tournament tree over the bins' free room
  finds it in a logarithm of steps: every inner node holds the larger room of its two
  children, so the way down takes the left child whenever that has enough.
* **Topping up.** Gaps that are left are filled with cuts of the emptiest bins' pieces;
  the last bin is cut into sequences whose lengths are powers of two. So a sequence is
  either full or a power of two, and nothing is padded.

A sequence's number is its group's number times 2^32 plus its place in the group. The
rows of ``docs`` must come in the same order whenever a file is read again (tables do):
a lost task then deals its rows out as before. Repeated rows are packed once each; rows
without an id too.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.bpe import byte_letters
from quizframe.llm.texts import U, mix, seeds, text_slices

CAPACITY = 2048
END_ID = 1
GROUP_BYTES = 4 << 20
GROUP_ROWS = 2048
#: Bytes of text tokenised at once.
SLICE = 500_000
#: White space beyond this length is more than the faster tokenizer's patterns take.
LONG_SPACE = 10_000

_DRAW = seeds(1, 8000)[0]


# ---- tokens -------------------------------------------------------------------


class Tokens:
    """Token ids of texts, as the ``tokenizers`` library gives them for a byte-level BPE file.

    Ordinary texts go through tiktoken with the same vocabulary and pattern, which gives
    the same ids in less than half of the time; texts that hold a special token or a very
    long run of white space go through the ``tokenizers`` library itself.
    """

    def __init__(self, spec: str):
        import tiktoken

        self.spec, self.library = spec, None
        parsed = json.loads(spec)
        self.special = [t["content"] for t in parsed["added_tokens"]]
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in t): i for t, i in parsed["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("packing", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.long_space = regex.compile(rf"\s{{{LONG_SPACE}}}")

    def ids(self, text: str) -> list[int]:
        plain = not any(s in text for s in self.special)
        if plain and not (len(text) >= LONG_SPACE and self.long_space.search(text)):
            return self.fast.encode_ordinary(text)
        if self.library is None:
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.library = Tokenizer.from_str(self.spec)
            self.library.no_padding()
            self.library.no_truncation()
        return self.library.encode(text, add_special_tokens=False).ids


# Fixed value: the pattern of the tokenizer's words.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(spark: SparkSession) -> str:
    """The setting ``quizframe.packing.tokenizer``, else the installed public file."""
    path = spark.conf.get("quizframe.packing.tokenizer", None)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, path: str, key: str, text: str, groups: int, capacity: int, end_id: int) -> DataFrame:
    """``(group, key, start, length, doc_tokens, ids)``: pieces of at most ``capacity`` tokens."""
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    width = np.uint16 if max(json.loads(spec)["model"]["vocab"].values(), default=0) < 65_000 and end_id < 65_536 else np.uint32
    # A worker keeps the value of a broadcast, and with it what its first task has made of it.
    shared = docs.sparkSession.sparkContext.broadcast({"spec": spec})
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    schema = T.StructType(
        [T.StructField("group", T.IntegerType()), T.StructField("key", docs.schema["key"].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches):
        from pyspark import TaskContext

        kept = shared.value
        if "tokens" not in kept:
            kept["tokens"] = Tokens(kept["spec"])
        tokens, met = kept["tokens"], TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in text_slices(batch, "body", SLICE):
                found = [np.array([*tokens.ids(t or ""), end_id], width) for t in part.column("body").to_pylist()]
                sizes = np.array([len(x) for x in found], np.int64)
                cuts = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(found)), cuts)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = nth * capacity
                length = np.minimum(capacity, sizes[owner] - start)
                place = mix((np.arange(len(owner)) + met).astype(U) ^ _DRAW)
                met += len(owner)
                of_piece = [found[o][a : a + n].tobytes() for o, a, n in zip(owner, start, length, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((place % U(groups)).astype(np.int32)),
                        part.column("key").take(pa.array(owner)),
                        *[pa.array(x) for x in (start, length, sizes[owner])],
                        pa.array(of_piece, pa.binary()),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(run, schema)


# ---- one group ----------------------------------------------------------------


class Tournament:
    """Free room of bins, with a tree that finds the first bin with enough of it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The first bin with room for ``need``; there is one."""
        at, room, leaves = 1, self.room, self.leaves
        while at < leaves:
            at *= 2
            if room[at] < need:
                at += 1
        return at - leaves

    def free(self, which: int) -> int:
        return self.room[which + self.leaves]

    def take(self, which: int, amount: int) -> None:
        room, at = self.room, which + self.leaves
        room[at] -= amount
        while at > 1:
            at //= 2
            larger = max(room[2 * at], room[2 * at + 1])
            if room[at] == larger:
                break
            room[at] = larger


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items (by index) of every bin; every length is 1 to ``capacity``."""
    tree = Tournament(len(lengths), capacity)
    bins: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = tree.first(lengths[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
        tree.take(at, lengths[item])
    return bins


Piece = tuple[int, int, int]  # item, first token in it, number of tokens


def topped_up(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Bins of pieces: all full but for the last ones, whose sizes are different powers of two."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (-fill[b], b))
    packed: list[list[Piece]] = [[(i, 0, lengths[i]) for i in bins[b]] for b in order]
    fill = [fill[b] for b in order]
    last = len(packed) - 1
    for at in range(len(packed)):
        while at < last and fill[at] < capacity:
            item, a, n = packed[last].pop()
            moved = min(n, capacity - fill[at])
            packed[at].append((item, a + n - moved, moved))
            if moved < n:
                packed[last].append((item, a, n - moved))
            fill[at] += moved
            fill[last] -= moved
            if not fill[last]:
                last -= 1
        if at >= last:
            break
    done, rest = packed[:last], packed[last] if packed else []
    left = fill[last] if packed else 0
    for size in (1 << k for k in range(capacity.bit_length(), -1, -1)):
        if left < capacity and not left & size:
            continue
        part, want = [], capacity if left == capacity else size
        while want:
            item, a, n = rest.pop()
            part.append((item, a + max(0, n - want), min(n, want)))
            if n > want:
                rest.append((item, a, n - want))
            want -= min(n, want)
        left -= sum(n for _, _, n in part)
        done.append(part)
        if not left:
            break
    return done


def packed_group(lengths: np.ndarray, capacity: int) -> list[list[Piece]]:
    """Sequences of one group: whole items of ``capacity`` by themselves, the others by first fit."""
    whole = [[(int(i), 0, capacity)] for i in np.flatnonzero(lengths == capacity)]
    rests = np.flatnonzero(lengths < capacity)
    sizes = lengths[rests].tolist()
    shared = topped_up(first_fit_decreasing(sizes, capacity), sizes, capacity)
    return whole + [[(int(rests[i]), a, n) for i, a, n in b] for b in shared]


# ---- all groups ---------------------------------------------------------------


def packed(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_bytes: int = GROUP_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``(key, start, length, ids, doc_tokens, sequence_id, offset)``: one row per piece.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers,
    ``start`` counts the tokens of its document before it, ``offset`` those of its
    sequence. An empty table gives no rows.
    """
    size = docs.select(F.sum(F.octet_length(text)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    groups = max(1, -(-(size["bytes"] or 0) // group_bytes), -(-size["rows"] // group_rows))
    cut = pieces(docs, path, key, text, groups, capacity, end_id)
    schema = T.StructType(
        [T.StructField(key, cut.schema["key"].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset")]
    )

    def run(table: pa.Table) -> pa.Table:
        # A fixed order, so that a group is packed alike whenever it is packed.
        table = table.sort_by([("key", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        length = table["length"].to_numpy()
        group = table["group"][0].as_py()
        found = packed_group(length, capacity)
        flat = np.array([p for b in found for p in b], np.int64).reshape(-1, 3)
        item, first, size = flat.T
        in_bin = np.array([len(b) for b in found])
        ends = np.cumsum(size)
        heads = np.cumsum(in_bin) - in_bin
        data = table["ids"].to_pylist()
        width = len(data[0]) // int(length[0])
        ids = [
            np.frombuffer(data[i], f"<u{width}")[a : a + n].astype("<u4").tobytes()
            for i, a, n in zip(item.tolist(), first.tolist(), size.tolist(), strict=True)
        ]
        chosen = pa.array(item)
        return pa.table(
            [
                table["key"].take(chosen),
                pa.array(table["start"].to_numpy()[item] + first),
                pa.array(size),
                pa.array(ids, pa.binary()),
                table["doc_tokens"].take(chosen),
                pa.array((group << 32) + np.repeat(np.arange(len(found)), in_bin)),
                pa.array(ends - size - np.repeat((ends - size)[heads], in_bin)),
            ],
            schema=None,
            names=schema.names,
        )

    return cut.groupBy("group").applyInArrow(run, schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece."""
    return packed(docs, path, key, text).select(
        key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
