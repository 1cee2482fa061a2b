"""Byte-pair encoding and decoding with a public vocabulary, in batched numpy merge rounds.

The vocabulary file (a ``tokenizers`` JSON of kind BPE with an end-of-word suffix)
is read once on the driver, turned into arrays and broadcast; its size is fixed.

Text to words: special tokens are cut out of the raw text; the rest is NFC
normalised and lower-cased, split at white space, and cut into contractions,
letter runs, single digits and runs of other characters.

Words to ids: a task gathers the distinct words of a slice that it has not met
yet and lays their bytes out as symbols in one flat array. In every round the keys
of neighbouring pairs that are new are looked up by binary search in the sorted table of mergeable
pairs; each word merges all places of its lowest-ranked pair, left to right, and words
without a mergeable pair leave the array. Where the merged symbol may be part of a pair
of as low a rank, the word merges its leftmost place only, since such a pair would come
first. The result is that of merging one place at a time, lowest rank first, leftmost
first.

NULL is encoded as the empty text, which has no ids and decodes to the empty text.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.texts import text_slices

#: A task forgets its words beyond so many, so its memory stays bounded.
CACHE_WORDS = 300_000
#: Bytes of new words merged at once.
MERGE_BYTES = 4_000_000

# Fixed values of the tokenizer's definition.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# str.split also parts at these, which are no white space to the tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Arrays for encoding and the token strings for decoding."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    letters = byte_letters()
    pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in model["merges"]], np.int64)
    # A pair listed twice has the rank of its last place.
    last = len(pairs) - 1 - np.unique(pairs[::-1], return_index=True)[1]
    merged = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
    # The lowest rank of a pair that each symbol is part of.
    least = np.full(max(vocab.values()) + 1, _NONE)
    for side in (pairs >> 32, pairs & 0xFFFFFFFF):
        np.minimum.at(least, side, np.arange(len(pairs)))
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
    return {
        "inner": np.array([vocab[c] for c in letters], np.int64),
        "final": np.array([vocab[c + end] for c in letters], np.int64),
        "pairs": pairs[last],
        "ranks": last.astype(np.int64),
        "merged": merged[last],
        "least": least,
        "tokens": [tokens.get(i, "") for i in range(max(tokens) + 1)],
        "special": special,
    }


def _ranked(vocabulary: dict, left: np.ndarray, right: np.ndarray):
    """(rank, merged symbol) of every pair; the rank of a pair that does not merge is the largest number."""
    keys = (left << 32) | right
    at = np.minimum(np.searchsorted(vocabulary["pairs"], keys), len(vocabulary["pairs"]) - 1)
    known = vocabulary["pairs"][at] == keys
    return np.where(known, vocabulary["ranks"][at], _NONE), vocabulary["merged"][at]


def merge_words(vocabulary: dict, words: list[bytes]) -> list[bytes]:
    """Ids of every (non-empty) word, as packed 32-bit numbers."""
    out: list[bytes] = [b""] * len(words)
    if not words:
        return out
    sizes = np.array([len(w) for w in words])
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocabulary["inner"][raw]
    ends = np.cumsum(sizes)
    symbols[ends - 1] = vocabulary["final"][raw[ends - 1]]
    # Of every place: its word, and rank and result of merging it with the next.
    name, owner = np.arange(len(words)), np.repeat(np.arange(len(words)), sizes)
    ranks, merged = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
    fresh = np.ones(len(symbols), bool)
    while len(symbols):
        fresh[-1] = False
        fresh[:-1] &= owner[1:] == owner[:-1]
        at = np.flatnonzero(fresh)
        ranks[at], merged[at] = _ranked(vocabulary, symbols[at], symbols[at + 1])
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        lowest = np.minimum.reduceat(ranks, starts)
        done = lowest == _NONE
        if done.any():
            gone = done[owner]
            packed = symbols[gone].astype(np.int32).tobytes()
            stops = (4 * np.cumsum(np.diff(starts, append=len(symbols))[done])).tolist()
            begin = 0
            for w, stop in zip(name[done].tolist(), stops, strict=True):
                out[w] = packed[begin:stop]
                begin = stop
            symbols, ranks, merged = symbols[~gone], ranks[~gone], merged[~gone]
            owner = (np.cumsum(~done) - 1)[owner[~gone]]
            lowest, name = lowest[~done], name[~done]
            if not len(symbols):
                break
        places = np.flatnonzero(ranks == lowest[owner])
        # Of places in a row (a pair of equal symbols), every second one.
        first = np.ones(len(places), bool)
        first[1:] = (places[1:] != places[:-1] + 1) | (owner[places[1:]] != owner[places[:-1]])
        run = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
        places = places[(np.arange(len(places)) - run) % 2 == 0]
        # Might the merged symbol make a pair that comes before the places left?
        own = owner[places]
        careful = vocabulary["least"][merged[places]] <= ranks[places]
        first = np.ones(len(places), bool)
        first[1:] = own[1:] != own[:-1]
        places = places[first | ~careful]
        symbols[places] = merged[places]
        left = np.ones(len(symbols), bool)
        left[places + 1] = False
        fresh = np.zeros(len(symbols), bool)
        fresh[places] = True
        # The pairs on both sides of a merged symbol are new.
        before = places[places > 0] - 1
        fresh[np.where(left[before], before, before - 1)] = True
        symbols, owner, ranks, merged, fresh = symbols[left], owner[left], ranks[left], merged[left], fresh[left]
        ranks[fresh] = _NONE
    return out


class Encoder:
    """Encodes texts with the words met so far remembered."""

    def __init__(self, vocabulary: dict):
        self.vocabulary = vocabulary
        self.words = regex.compile(_WORDS)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary["special"], key=len)[::-1])) + ")")
        self.known: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        # White space is in no chunk, so it marks the special tokens.
        self.known = {f" {t}": np.int32(i).tobytes() for t, i in self.vocabulary["special"].items()}

    def chunks(self, text: str) -> list[str]:
        """Runs without white space of the normalised text, and marked special tokens."""
        if "<" in text and len(parts := self.special.split(text)) > 1:
            return [c for i, p in enumerate(parts) for c in ([f" {p}"] if i % 2 else self.chunks(p))]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in _SEPARATORS):
            return regex.findall(r"\S+", text)
        return text.split()

    def learn(self, chunks: set[str]) -> None:
        """Encodes the chunks not known yet."""
        if len(self.known) > CACHE_WORDS:
            self._forget()
        missing = [c for c in chunks if c not in self.known]
        cut = [(c,) if c.isalpha() else self.words.findall(c) for c in missing]
        words = list(dict.fromkeys(w for ws in cut for w in ws))
        ids: dict[str, bytes] = {}
        at = 0
        encoded = [w.encode("utf-8", "surrogatepass") for w in words]
        ends = np.cumsum([len(w) for w in encoded], dtype=np.int64)
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MERGE_BYTES, side="right")))
            ids |= zip(words[at:to], merge_words(self.vocabulary, encoded[at:to]), strict=True)
            at = to
        self.known |= ids
        for chunk, ws in zip(missing, cut, strict=True):
            if len(ws) != 1:
                self.known[chunk] = b"".join([ids[w] for w in ws])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        chunks = [self.chunks(t) for t in texts]
        self.learn(set().union(*chunks))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, c)), np.int32) for c in chunks]


def decode(tokens: list[str], ids: np.ndarray) -> str:
    """The token strings with one space between them, special tokens included."""
    return " ".join(map(tokens.__getitem__, ids.tolist()))


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the token ids of ``text`` and the text decoded from them.

    All columns stay; one named like an output is replaced.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    docs = docs.drop(ids, decoded)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    )

    def run(batches):
        encoder = Encoder(vocabulary.value)
        tokens = vocabulary.value["tokens"]
        for batch in batches:
            for part in text_slices(batch, text):
                found = encoder.encode([t or "" for t in part.column(text).to_pylist()])
                ends = np.concatenate(([0], np.cumsum([len(x) for x in found], dtype=np.int64)))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(found)))
                texts = pa.array([decode(tokens, x) for x in found], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, lists, texts], names=schema.names)

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)`` of every row."""
    return encoded(docs.select(key, text), path, text).select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenizer_path(spark: SparkSession) -> str:
    """The setting ``quizframe.tokenizer``, else the installed public file."""
    path = spark.conf.get("quizframe.tokenizer", None)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
