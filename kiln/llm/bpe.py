"""Byte-level BPE over Arrow batches.

Bytes are mapped to printable characters (the usual byte-level table), the
tokenizers library merges them by rank, and ids come back as flat arrays.
Texts are first cut, at bytes, in places where the splitting pattern always
cuts too: before a space between two non-space characters, between a Latin letter
and punctuation, and around line breaks.  A batch then holds few distinct chunks, each is tokenised once, and
the ids of a text are gathered from its chunks.

Token offsets follow from the byte lengths of the tokens; a token's character
span runs from the character that holds its first byte to the one that holds
its last, so a character split over tokens belongs to each of them.  Decoding
reverses the byte table and joins bytes before reading them as UTF-8, so split
characters come out whole; bytes that are no UTF-8 become U+FFFD.

Defined results: null and empty texts have no ids; repeated rows are encoded
alike; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import by_value, text_or_empty

SLICE_BYTES = 4 << 20


def byte_table() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256))
    return [chr(b) if b in plain else chr(0x100 + next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from lines of base64 and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def merges_of(tokens: list[bytes]) -> list[tuple[bytes, bytes]]:
    """For each longer token, in rank order, the pair that its own merge joins.

    The pair is what stays of the token's bytes once all merges of lower rank
    are made.
    """
    rank = {t: i for i, t in enumerate(tokens)}
    out = []
    for i, token in enumerate(tokens):
        if len(token) < 2:
            continue
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            ranks = [rank.get(parts[k] + parts[k + 1], i) for k in range(len(parts) - 1)]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] >= i:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def tokenizer_from_ranks(path: str, pattern: str):
    """A tokenizers.Tokenizer with the ids and merges of a rank file."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_table()

    def shown(b: bytes) -> str:
        return "".join(chars[x] for x in b)

    tokens = read_ranks(path)
    model = models.BPE({shown(t): i for i, t in enumerate(tokens)}, [(shown(a), shown(b)) for a, b in merges_of(tokens)])
    out = Tokenizer(model)
    out.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return out


def load_tokenizer(path: str, pattern: str | None = None):
    """From a tokenizer's JSON file, or from a rank file with the pattern that splits text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(path)
    else:
        out = tokenizer_from_ranks(path, pattern)
    out.encode_special_tokens = True  # Encoder finds special tokens itself, so chunks never hold one
    return out


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id: the byte table reversed."""
    back = {c: b for b, c in enumerate(byte_table())}
    size = max(tokenizer.get_vocab().values()) + 1
    out = [b""] * size
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def _kinds() -> bytes:
    """For each byte: bit 0 ink, 1 letter, 2 space or line break, 3 punctuation, 4 ink that begins a character, 5 space, 6 line break."""
    out = bytearray(256)
    for b in range(0x21, 0x7F):
        out[b] = 0b10001 | (0b10 if chr(b).isalpha() else 0 if chr(b).isdigit() else 0b1000)
    out[0x20], out[0x0A] = 0b100100, 0b1000100
    return bytes(out)


_KINDS = _kinds()
#: A chunk that the pattern leaves whole: letters, after a space or not.
_ONE_WORD = "\\A ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+\\z"
#: First byte of the letters U+00C0 to U+00FF, and the second bytes of them that are signs (U+00D7, U+00F7).
_LATIN, _SIGNS = 0xC3, (0x97, 0xB7)


def chunk_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted starts of chunks: text starts and places where the splitting pattern cuts whatever surrounds them."""
    n = len(data)
    kind = np.frombuffer(bytearray(data).translate(_KINDS), np.uint8)
    # Latin letters of two bytes begin at the first byte, and are ink and a letter at the last
    first = np.flatnonzero(data[:-1] == _LATIN)
    first = first[~np.isin(data[first + 1], _SIGNS)]
    kind[first] |= 0b10000
    kind[first + 1] |= 0b11
    begin = np.zeros(n + 1, np.uint8)
    # before a space or line break that follows ink, and between a letter and punctuation; before a space that
    # precedes ink; after a line break between ink (in a longer run of white space the pattern looks ahead)
    begin[1:n] = kind[:-1] & (kind[1:] >> 2) & 0b11
    begin[: n - 1] |= (kind[:-1] >> 1) & kind[1:] & 0b10000
    begin[2:n] |= (kind[1:-1] >> 2) & kind[2:] & (kind[:-2] << 4) & 0b10000
    edges = off[:-1][off[:-1] < off[1:]]
    # a text's first and last byte see no neighbour of another text
    inner = np.union1d(off[1:], off[1:] - 1)
    begin[inner[(inner >= 0) & (inner <= n)]] = 0
    begin[edges] = 1
    return np.flatnonzero(begin[:n])


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs of ``count`` places, one run after another."""
    before = np.cumsum(count) - count
    out = np.repeat(start - before, count)
    out += np.arange(len(out), dtype=out.dtype)
    return out


def _flat(lists: list, ids) -> tuple[np.ndarray, np.ndarray]:
    """(length of each list, all their ids)."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return counts, np.fromiter(ids, np.uint32, int(counts.sum()))


class Encoder:
    """Encodes Arrow string arrays to flat ids; holds a tokenizer and the ids of chunks seen.

    The store is bounded in bytes: at most MOST_CACHED chunks of at most LONGEST
    characters, and MOST_IDS ids beside those of the slice at work; longer chunks
    are tokenised again wherever they occur.  When it is full, the chunks of the
    last slice stay, the others go.  A worker keeps it from task to task.

    Special tokens of the tokenizer's file are found as the library finds them:
    before anything else, each as one id, with the text between them apart.
    """

    MOST_CACHED = 600_000
    LONGEST = 64
    MOST_IDS = 4_000_000

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.shown = np.array([ord(c) for c in byte_table()], np.uint16)
        added = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("special tokens that take in or look at their neighbours are not supported")
        self.special = {t.content.encode(): i for i, t in added.items()}
        self.any_special = re.compile(b"|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))) if added else None
        self.last: list[str] = []
        self.seen: dict[str, int] = {}
        self.flat, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _shrink(self) -> None:
        place = np.fromiter(map(self.seen.__getitem__, self.last), np.int64, len(self.last))
        count = self.begin[place + 1] - self.begin[place]
        ids = self.flat[_runs(self.begin[place], count)]
        self.seen, self.flat, self.begin = {}, np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self._store(self.last, [(count, ids)])

    def _codes(self, distinct: pa.Array) -> np.ndarray:
        """Place of each chunk in the store; new chunks are tokenised and stored, long ones for this time only."""
        if len(self.seen) + len(distinct) > self.MOST_CACHED or len(self.flat) > self.MOST_IDS:
            self._shrink()
        chunks = distinct.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.seen.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(place < 0)
        whole = pc.match_substring_regex(distinct.take(pa.array(new)), _ONE_WORD).to_numpy(zero_copy_only=False).astype(bool)
        words, rest = ([chunks[i] for i in new[w].tolist()] for w in (whole, ~whole))
        place[new[whole]] = self._store(words, self._word_ids(words))
        if rest:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            place[new[~whole]] = self._store(rest, [_flat(found, chain.from_iterable(found))])
        long = [c for some in (words, rest) for c in some if len(c) > self.LONGEST]
        for c in long:
            del self.seen[c]
        self.last = [c for c in chunks if len(c) <= self.LONGEST] if long else chunks
        return place

    def _word_ids(self, words: list[str]):
        """(number of ids of each word, ids) for some hundreds of words at a time, whose tokens stay in the processor's cache."""
        tokenize, get_id = self.tokenizer.model.tokenize, attrgetter("id")
        for at in range(0, len(words), 20_000):
            # bytes to characters, all words at once; a zero byte parts them
            data = np.frombuffer("\0".join(words[at : at + 20_000]).encode(), np.uint8)
            shown = self.shown[data].tobytes().decode("utf-16-le").split(chr(self.shown[0]))
            for k in range(0, len(shown), 250):
                found = list(map(tokenize, shown[k : k + 250]))
                yield _flat(found, map(get_id, chain.from_iterable(found)))

    def _store(self, chunks: list[str], parts) -> np.ndarray:
        """Append chunks whose ids come in ``parts`` of (counts, ids); their places.  Arrays given out stay as they are."""
        counts, ids = zip((np.zeros(0, np.int64), np.zeros(0, np.uint32)), *parts)
        place = len(self.begin) - 1 + np.arange(len(chunks))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.concatenate(counts))])
        self.flat = np.concatenate([self.flat, *ids])
        self.seen.update(zip(chunks, place.tolist()))
        return place

    def slices(self, col: pa.Array):
        """(first row, end row, ids, id offsets, bytes, byte offsets) per slice of the array."""
        for lo, hi, data, off in ts.slices(col, SLICE_BYTES):
            ids, id_off = self.encode(data, off)
            yield lo, hi, ids, id_off, data, off

    def _special_places(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """(row, start, end, id) of special tokens, none over the border of two texts."""
        raw, at, found = data.tobytes(), 0, []
        while self.any_special and (m := self.any_special.search(raw, at)):
            row = int(np.searchsorted(off, m.start(), side="right")) - 1
            if m.end() <= off[row + 1]:
                found.append((row, m.start(), m.end(), self.special[m.group()]))
                at = m.end()
            else:
                at = m.start() + 1
        row, start, end = (np.array([f[k] for f in found], np.int64) for k in range(3))
        return row, start, end, [f[3] for f in found]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offset of each text's ids) of texts that lie one after another in ``data``."""
        row, start, end, special = self._special_places(data, off)
        if not special:
            return self._encode(data, off)
        n = len(off) - 1
        between = np.ones(len(data), bool)
        for a, z in zip(start, end):
            between[a:z] = False
        # a text with k special tokens has k + 1 sections, which are texts of their own
        sections = np.sort(np.concatenate([off[1:], start])) - np.sort(np.concatenate([off[:-1], end]))
        of = np.sort(np.concatenate([np.arange(n), row]))
        ids, id_off = self._encode(data[between], np.concatenate([[0], np.cumsum(sections)]))
        ids = np.insert(ids, id_off[1:-1][of[1:] == of[:-1]], special)
        count = np.bincount(of, weights=np.diff(id_off), minlength=n).astype(np.int64) + np.bincount(row, minlength=n)
        return ids, np.concatenate([[0], np.cumsum(count)])

    def _encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(off) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        starts = chunk_starts(data, off)
        ends = np.append(starts, len(data)).astype(np.int32)
        chunks = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
        coded = chunks.dictionary_encode()
        which = self._codes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        count = self.begin[which + 1] - self.begin[which]
        through = np.concatenate([[0], np.cumsum(count)])
        at = np.searchsorted(starts, off[:-1])  # first chunk of each text
        return self.flat[_runs(self.begin[which], count)], through[np.append(at, len(starts))]


def encoder(path: str, pattern: str | None = None) -> Encoder:
    """An encoder whose tokenizer a Python worker keeps from task to task, where it can import this package."""
    try:
        from kiln.llm import bpe as home
    except ImportError:  # pickled by value to a worker without the package
        return Encoder(load_tokenizer(path, pattern))
    kept = home.__dict__.setdefault("_ENCODERS", {})
    if (path, pattern) not in kept:
        kept[path, pattern] = home.Encoder(home.load_tokenizer(path, pattern))
    return kept[path, pattern]


class ByteTable:
    """Gathers per-id byte strings into one buffer."""

    def __init__(self, pieces: list[bytes]):
        self.lens = np.array([len(p) for p in pieces], np.int64)
        self.begin = np.cumsum(self.lens) - self.lens
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def gather(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end of each id's bytes)."""
        count = self.lens[ids]
        end = np.cumsum(count)
        if not len(ids):
            return np.zeros(0, np.uint8), end
        pos = np.arange(int(end[-1]), dtype=np.int64) + np.repeat(self.begin[ids] - end + count, count)
        return self.data[pos], end


def character_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point spans of the tokens of one text, from its bytes and the byte end of each token."""
    through = np.cumsum((data & 0xC0) != 0x80)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return through[starts] - 1, through[ends - 1]


def decode(ids, table: list[bytes]) -> str:
    """Text of ids; characters split over tokens come out whole, stray bytes as U+FFFD."""
    return b"".join(table[i] for i in ids).decode("utf-8", "replace")


TOKENS_TYPE = "struct<ids:array<int>,starts:array<int>,ends:array<int>>"


@by_value
def with_tokens(df: DataFrame, path: str, pattern: str | None = None, text_col: str = "text", out: str = "tokens") -> DataFrame:
    """``df`` with ids and code point spans of the tokens of each whole text."""

    def encode(batches):
        enc = encoder(path, pattern)
        table = ByteTable(token_bytes(enc.tokenizer))
        for col in batches:
            ids, starts, ends, counts = [], [], [], [np.zeros(1, np.int64)]
            for lo, hi, flat, id_off, data, off in enc.slices(col):
                _, end = table.gather(flat)
                ids.append(flat)
                counts.append(np.diff(id_off))
                for i in range(hi - lo):
                    a, b = id_off[i], id_off[i + 1]
                    if b > a:
                        s, e = character_spans(data[off[i] : off[i + 1]], end[a:b] - off[i])
                        starts.append(s)
                        ends.append(e)
            offsets = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)))
                for x in (ids, starts, ends)
            ]
            yield pa.StructArray.from_arrays(lists, names=["ids", "starts", "ends"])

    return df.withColumn(out, _iterating(encode, TOKENS_TYPE)(text_or_empty(text_col)))


@by_value
def with_decoded(df: DataFrame, path: str, pattern: str | None = None, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with the text of an id array; null ids read as none, unknown ids as no bytes."""

    def back(batches):
        table = token_bytes(load_tokenizer(path, pattern))
        for col in batches:
            yield pa.array([decode([i for i in ids or () if i is not None and 0 <= i < len(table)], table) for ids in col.to_pylist()], pa.string())

    return df.withColumn(out, _iterating(back, "string")(F.col(f"`{ids_col}`")))


def _iterating(fn, returns: str):
    """An Arrow function over an iterator of batches, so that a task loads its tokenizer once."""
    from collections.abc import Iterator

    fn.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(fn, returnType=returns)


ROUND_TRIP_TYPE = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string,same:boolean>"


@by_value
def round_trip(df: DataFrame, path: str, pattern: str | None = None, text_col: str = "text", out: str = "digest") -> DataFrame:
    """``df`` with digests of each text's ids and of what they decode to."""

    def digest(batches):
        enc = encoder(path, pattern)
        pieces = token_bytes(enc.tokenizer)
        raw, decimal = ByteTable(pieces), ByteTable([b"%d " % i for i in range(len(pieces))])
        for col in batches:
            n, ids_sha, text_sha, same = [], [], [], []
            for lo, hi, flat, id_off, data, off in enc.slices(col):
                back, end = raw.gather(flat)
                shown, shown_end = decimal.gather(flat)
                end, shown_end = np.append(0, end), np.append(0, shown_end)
                for i in range(hi - lo):
                    a, b = id_off[i], id_off[i + 1]
                    n.append(b - a)
                    text = back[end[a] : end[b]]
                    ids_sha.append(hashlib.sha256(shown[shown_end[a] : max(shown_end[b] - 1, shown_end[a])]).hexdigest())
                    text_sha.append(hashlib.sha256(text).hexdigest())
                    same.append(bool(np.array_equal(text, data[off[i] : off[i + 1]])))
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                names=["n_tokens", "ids_sha256", "decoded_sha256", "same"],
            )

    return df.withColumn(out, _iterating(digest, ROUND_TRIP_TYPE)(text_or_empty(text_col)))


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = round_trip(docs, vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
    return out.select("doc_id", "digest.*")
