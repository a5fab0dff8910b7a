"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For a merge list the last token of every prefix of a piece is unique. It is
found from left to right: among the tokens that end at the prefix's end (the
suffix matches), it is the one that is compatible with the last token of the
prefix before it, where two tokens are compatible if BPE of their joined bytes
gives back just these two (tested by undoing merges along the seam). Back
pointers from the last prefix give the ids; no merges are replayed.

* Suffix matches: one automaton over all tokens (Aho and Corasick's suffix
  automaton of a dictionary): its state at a byte names the longest token that
  ends there, and each token names its longest proper suffix that is a token.
* Pieces are split off by the pretokenizer's pattern, worked out by numpy over
  code point classes: letters, numbers, white space, others. Special tokens
  in the text are cut out first and stand for their ids.
* Each distinct piece of a slice is encoded once; pieces that share a hash are
  compared code point by code point with the one that stands for them. They are
  encoded in the order of their bytes, each from the prefix it shares with the one
  before. Piece results are kept in a cache of bounded size for the task's later slices.

There is no shuffle. The tokenizer file is a public one, given by path; every
worker reads it from the installed package, or ``vocabulary`` ships its text.

Defined results: null reads as the empty text, which has no ids and decodes to
the empty text; rows are handled one by one, whole texts. Only the key and the
text column are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .text import map_columns, map_texts, ranges, slices, span_hashes, utf8

CACHE_PIECES = 100_000
CACHE_PAIRS = 300_000
KEPT_WAYS = 1_000_000
SLICE = 1_000_000

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in a byte-level vocabulary: bytes
    that print as they are stand for themselves, the others get the code
    points from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


# Letters and numbers of Unicode 16, which the tokenizers library
# knows and Python's own table (15.1) does not: first, last, class.
ADDED = (
    (0x1C89, 0x1C8A, _LETTER), (0xA7CB, 0xA7CD, _LETTER), (0xA7DA, 0xA7DC, _LETTER), (0x105C0, 0x105F3, _LETTER),
    (0x10D40, 0x10D49, _NUMBER), (0x10D4A, 0x10D65, _LETTER), (0x10D6F, 0x10D85, _LETTER),
    (0x10EC2, 0x10EC4, _LETTER), (0x11380, 0x11389, _LETTER), (0x1138B, 0x1138B, _LETTER),
    (0x1138E, 0x1138E, _LETTER), (0x11390, 0x113B5, _LETTER), (0x113B7, 0x113B7, _LETTER),
    (0x113D1, 0x113D1, _LETTER), (0x113D3, 0x113D3, _LETTER), (0x116D0, 0x116E3, _NUMBER),
    (0x11BC0, 0x11BE0, _LETTER), (0x11BF0, 0x11BF9, _NUMBER), (0x13460, 0x143FA, _LETTER),
    (0x16100, 0x1611D, _LETTER), (0x16130, 0x16139, _NUMBER), (0x16D40, 0x16D6C, _LETTER),
    (0x16D70, 0x16D79, _NUMBER), (0x18CFF, 0x18CFF, _LETTER), (0x1CCF0, 0x1CCF9, _NUMBER),
    (0x1E5D0, 0x1E5ED, _LETTER), (0x1E5F0, 0x1E5F0, _LETTER), (0x1E5F1, 0x1E5FA, _NUMBER),
)


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point, as the pretokenizer's pattern sees it."""
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for first, last, k in ADDED:
        out[first:last + 1] = k
    out[[c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c < 0x20]] = _SPACE
    return out


@dataclass
class Vocabulary:
    """A byte-level BPE vocabulary, its merges and its suffix automaton."""

    tokens: list[bytes]
    halves: list[tuple[int, int]]  # the two tokens that a token was merged from
    rank: dict[tuple[int, int], int]  # merge -> rank
    made_at: list[int]  # token -> rank of its merge; -1 for a byte
    special: dict[str, int]
    goes: list[dict[int, int]] = field(default_factory=list)
    fail: list[int] = field(default_factory=list)
    longest: list[int] = field(default_factory=list)  # state -> longest token that ends its string
    shorter: list[int] = field(default_factory=list)  # token -> longest proper suffix that is a token
    sizes: list[int] = field(default_factory=list)  # of the tokens, in bytes
    flat: np.ndarray | None = None  # the tokens' bytes
    first: np.ndarray | None = None
    compatible_pairs: dict[int, bool] = field(default_factory=dict)
    cache: dict[bytes, list[int]] = field(default_factory=dict)
    kept_ways: int = 0  # ways added to the automaton by ``_next_state``


def read_vocabulary(text: str) -> Vocabulary:
    """A vocabulary from a tokenizer file's JSON text."""
    spec = json.loads(text)
    model, letters = spec["model"], byte_letters()
    ids = model["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    size = max([*ids.values(), *special.values()]) + 1
    tokens: list[bytes] = [b""] * size
    for piece, i in ids.items():
        tokens[i] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
    for piece, i in special.items():
        tokens[i] = piece.encode()
    plain = {t: i for i, t in enumerate(tokens) if t and i not in set(special.values())}
    halves, made_at = [(-1, -1)] * size, [-1] * size
    rank: dict[tuple[int, int], int] = {}
    for n, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        a, b, both = ids[a], ids[b], ids[a + b]
        if made_at[both] >= 0:
            raise ValueError(f"token {both} is made by two merges")
        rank[a, b] = n
        halves[both], made_at[both] = (a, b), n
    v = Vocabulary(tokens, halves, rank, made_at, special)
    # Tokens that BPE never makes (their bytes merge in another way) match nothing.
    reached = [made < 0 for made in made_at]
    for (a, b), n in rank.items():  # in rank order
        reached[plain[tokens[a] + tokens[b]]] = reached[a] and reached[b] and _seam_holds(v, a, b, n)
    _build_automaton(v, {t: i for t, i in plain.items() if reached[i]})
    v.sizes = [len(t) for t in tokens]
    v.flat = np.frombuffer(b"".join(tokens), np.uint8)
    v.first = np.concatenate([[0], np.cumsum(v.sizes)])
    return v


def _build_automaton(v: Vocabulary, plain: dict[bytes, int]) -> None:
    goes: list[dict[int, int]] = [{}]
    token_at = [-1]
    for token, i in plain.items():
        s = 0
        for b in token:
            if b not in goes[s]:
                goes[s][b] = len(goes)
                goes.append({})
                token_at.append(-1)
            s = goes[s][b]
        token_at[s] = i
    fail, longest, shorter = [0] * len(goes), [-1] * len(goes), [-1] * len(v.tokens)
    queue = [0]
    for s in queue:  # by length of the states' strings
        for b, q in goes[s].items():
            f = fail[s]
            while f and b not in goes[f]:
                f = fail[f]
            fail[q] = goes[f][b] if s and b in goes[f] else 0
            longest[q] = token_at[q] if token_at[q] >= 0 else longest[fail[q]]
            if token_at[q] >= 0:
                shorter[token_at[q]] = longest[fail[q]]
            queue.append(q)
    v.goes, v.fail, v.longest, v.shorter = goes, fail, longest, shorter


def _seam_holds(v: Vocabulary, a: int, b: int, limit: int) -> bool:
    """Whether nothing merges over the seam of ``a`` and ``b`` while they are
    made. The tokens are undone from the last merge back, which shows the
    seam's neighbours at every moment; ``limit`` is the rank from which on a
    merge of the neighbours comes too late."""
    rank, made_at, halves = v.rank, v.made_at, v.halves
    while True:
        if rank.get((a, b), limit) < limit:
            return False
        ra, rb = made_at[a], made_at[b]
        if ra < 0 and rb < 0:
            return True
        # Undo the later of the two merges; at equal rank the left one comes
        # first, so the right one is undone first. A seam merge of the same
        # rank comes before one on its right and after one on its left.
        if rb >= ra:
            limit = rb + 1
            b = halves[b][0]
        else:
            limit = ra
            a = halves[a][1]


def compatible(v: Vocabulary, left: int, right: int) -> bool:
    """Whether BPE leaves ``left`` and ``right`` as two tokens when they stand
    side by side."""
    ok = _seam_holds(v, left, right, 1 << 60)
    if len(v.compatible_pairs) >= CACHE_PAIRS:
        v.compatible_pairs.clear()
    v.compatible_pairs[left << 20 | right] = ok
    return ok


def encode_piece(v: Vocabulary, data: bytes) -> list[int]:
    """The ids of one piece, from the last tokens of its prefixes."""
    return encode_pieces(v, [data])[0]


def _next_state(v: Vocabulary, state: int, byte: int) -> int:
    """Where the automaton goes from a state that has no own way for a byte; kept, up to a number."""
    goes, s = v.goes, v.fail[state] if state else -1
    while s > 0 and byte not in goes[s]:
        s = v.fail[s]
    found = goes[s].get(byte, 0) if s >= 0 else 0
    if v.kept_ways < KEPT_WAYS:
        goes[state][byte] = found
        v.kept_ways += 1
    return found


def encode_pieces(v: Vocabulary, pieces: Sequence[bytes]) -> list[list[int]]:
    """The ids of each piece. What is known of the prefix that a piece has in common with
    the one before it is taken over, so sorted pieces cost least."""
    goes, longest, shorter, sizes, known = v.goes, v.longest, v.shorter, v.sizes, v.compatible_pairs
    last: list[int] = []
    states: list[int] = [0]  # after so many bytes
    out: list[list[int]] = []
    before = b""
    for data in pieces:
        end = 0
        for x, y in zip(before, data, strict=False):
            if x != y:
                break
            end += 1
        del last[end:], states[end + 1:]
        before = data
        state = states[end]
        for byte in data[end:]:
            end += 1
            to = goes[state].get(byte)
            state = to if to is not None else _next_state(v, state, byte)
            states.append(state)
            token = longest[state]
            while start := end - sizes[token]:
                left = last[start - 1]
                ok = known.get(left << 20 | token)
                if ok is None:
                    ok = compatible(v, left, token)
                if ok:
                    break
                token = shorter[token]
            last.append(token)
        ids = []
        while end:
            token = last[end - 1]
            ids.append(token)
            end -= sizes[token]
        out.append(ids[::-1])
    return out


def split_pieces(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Starts of the pieces in code points that are cut at ``cuts`` (sorted,
    with 0 and the end), each part being pretokenized on its own.

    The pattern: contractions; an optional blank and letters, or numbers, or
    others; white space, without the last one if something follows."""
    n = len(points)
    kind = classes()[points]
    inner = cuts[cuts < n]
    at = np.zeros(n + 1, bool)
    at[1:n] = kind[1:] != kind[:-1]
    at[inner] = True
    at[n] = True
    part_start = np.zeros(n + 1, bool)
    part_start[inner] = True
    part_start[n] = True
    # Last white space of a run with something behind it in the same part.
    space = np.zeros(n + 1, bool)
    space[:n] = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~part_start[1:])
    at[last] = True
    blank = last[points[last] == 0x20]
    at[blank + 1] = False  # a blank goes with what follows
    # Contractions: an apostrophe that opens a piece.
    quote = np.flatnonzero((points == 0x27) & at[:n])
    quote = quote[quote + 1 < n]
    quote = quote[~part_start[quote + 1]]
    second = points[quote + 1]
    one = np.isin(second, [ord(c) for c in "stmd"])
    third_at = np.minimum(quote + 2, n - 1)
    third = np.where((quote + 2 < n) & ~part_start[third_at], points[third_at], 0)
    two = ((second == ord("r")) & (third == ord("e"))) | ((second == ord("v")) & (third == ord("e"))) \
        | ((second == ord("l")) & (third == ord("l")))
    short, long_ = quote[one], quote[two]
    at[np.concatenate([short, long_]) + 1] = False
    at[short + 2] = True
    at[long_ + 3] = True
    return np.flatnonzero(at[:n])


def _cut_at_special(v: Vocabulary, points: np.ndarray, row_start: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
    """Cuts (rows and special tokens) and the special tokens by their start."""
    found: dict[int, int] = {}
    cuts = [row_start]
    for text, token in v.special.items():
        probe = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.flatnonzero(points[:len(points) - len(probe) + 1] == probe[0]) if len(points) >= len(probe) else []
        for s in at if len(at) == 0 else at[[bool((points[s:s + len(probe)] == probe).all()) for s in at]]:
            s, e = int(s), int(s) + len(probe)
            if np.searchsorted(row_start, s, side="right") == np.searchsorted(row_start, e - 1, side="right"):
                found[s] = token
                cuts.append(np.array([s, e]))
    return np.unique(np.concatenate(cuts)), found


def encode_texts(v: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, flat, and for each text its first id's place (one
    more entry at the end)."""
    rows = texts.cast(pa.large_string()).fill_null("")
    sizes = pa.compute.utf8_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    row_start = np.concatenate([[0], np.cumsum(sizes)])
    data, _ = utf8(rows)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    cuts, special = _cut_at_special(v, points, row_start)
    start = split_pieces(points, cuts)
    if special:  # a special token is a single piece
        inside = np.concatenate([np.arange(s + 1, s + len(v.tokens[t])) for s, t in special.items()])
        start = np.setdiff1d(start, inside)
    end = np.append(start[1:], len(points))
    _, rep, which = np.unique(span_hashes(points, start, end), return_index=True, return_inverse=True)
    # Pieces with one hash must be one piece; else each is taken by itself.
    shift = start[rep][which] - start
    same = (end - start) == (end[rep] - start[rep])[which]
    if same.all():
        alike = points == points[np.repeat(shift, end - start) + np.arange(len(points))]
        same = np.logical_and.reduceat(alike, start)
    if not same.all():
        rep, which = np.arange(len(start)), np.arange(len(start))
    wide = np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))
    text, byte_at = data.tobytes(), np.concatenate([[0], wide])
    encoded = _encode_cached(v, [text[a:b] for a, b in zip(byte_at[start[rep]].tolist(), byte_at[end[rep]].tolist(),
                                                           strict=True)])
    if special:
        encoded = [x if a not in special else [special[a]] for a, x in zip(start[rep].tolist(), encoded, strict=True)]
    size = np.array([len(x) for x in encoded], np.int64)
    place = np.concatenate([[0], np.cumsum(size)])
    known = np.fromiter(itertools.chain.from_iterable(encoded), np.uint32, int(place[-1]))
    ids = known[ranges(place[which], size[which])]
    piece_id = np.concatenate([[0], np.cumsum(size[which])])
    return ids, piece_id[np.searchsorted(start, row_start)]


def _encode_cached(v: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    """The ids of each piece: from the cache, or encoded in the order of their bytes."""
    cache = v.cache
    out = [cache.get(p) for p in pieces]
    missing = sorted({p for p, ids in zip(pieces, out, strict=True) if ids is None})
    if not missing:
        return out
    found = dict(zip(missing, encode_pieces(v, missing), strict=True))
    out = [ids if ids is not None else found[p] for p, ids in zip(pieces, out, strict=True)]
    for p, ids in found.items():
        if len(p) <= 64:
            if len(cache) >= CACHE_PIECES:  # the older half goes
                for old in list(cache)[:CACHE_PIECES // 2]:
                    del cache[old]
            cache[p] = ids
    return out


def decode_ids(v: Vocabulary, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The UTF-8 text of each row's ids (bytes that are no UTF-8 become U+FFFD)."""
    size = (v.first[1:] - v.first[:-1])[ids]
    flat = v.flat[ranges(v.first[ids], size)].tobytes()
    place = np.concatenate([[0], np.cumsum(size)])[first].tolist()
    return [flat[a:b].decode("utf-8", "replace").encode() for a, b in zip(place, place[1:], strict=False)]


@functools.lru_cache(maxsize=2)
def load(path: str | None) -> Vocabulary:
    """The vocabulary of a tokenizer file, once for each worker process."""
    if path is None or "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path or "byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return read_vocabulary(f.read())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per document: key and ``ids``."""
    def work(texts: pa.Array) -> dict[str, object]:
        ids, first = encode_texts(load(tokenizer), texts)
        return {"ids": pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))}

    return map_texts(docs, key, text, [T.StructField("ids", T.ArrayType(T.IntegerType()))], work, SLICE)


def encode_rows(docs: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """The rows without their text, with ``n_tokens`` and ``ids`` at the end
    (columns of these names are replaced)."""
    kept = [c for c in docs.columns if c not in (text, "n_tokens", "ids")]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("n_tokens", T.LongType()),
                                                            T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(tokenizer)
        for batch in batches:
            _, offsets = utf8(batch.column(0))
            for i, j in slices(offsets, SLICE):
                part = batch.slice(i, j - i)
                ids, first = encode_texts(v, part.column(0))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(np.diff(first)), lists],
                                                 names=schema.names)

    rows = docs.select(text, *["`" + c.replace("`", "``") + "`" for c in kept])
    return map_columns(rows, run, schema.fields)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """One row per row of ids: key and ``text`` (null ids read as none)."""
    kind = encoded.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(tokenizer)
        for batch in batches:
            rows = batch.column(1)
            n = pa.compute.fill_null(pa.compute.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            for i, j in slices(first, SLICE):
                part = rows.slice(i, j - i).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = decode_ids(v, part, first[i:j + 1] - first[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(
                    [t.decode() for t in texts], pa.string())], names=[key, "text"])

    return encoded.select(key, ids).mapInArrow(run, schema)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per document: key, ``n_tokens``, ``ids_sha256`` (ids as little-endian
    32-bit numbers) and ``decoded_sha256`` (the decoded text in UTF-8)."""
    def work(texts: pa.Array) -> dict[str, object]:
        v = load(tokenizer)
        ids, first = encode_texts(v, texts)
        cut = first.tolist()
        little = ids.astype("<u4")
        return {
            "n_tokens": np.diff(first),
            "ids_sha256": [hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)],
            "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in decode_ids(v, ids, first)]}

    return map_texts(docs, key, text, [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())], work, SLICE)
