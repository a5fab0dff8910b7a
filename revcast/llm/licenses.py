"""License scan with a generalised suffix automaton of license words.

All notice texts and base phrases, as sequences of words, go into one suffix
automaton. Documents are streamed through it word by word, which gives the
matching statistics: at each word the length of the longest suffix that stands
in some notice, and the automaton's state. Then

* a base phrase ends wherever it is a suffix of the current match (a bit mask
  of phrases for each state, carried down the suffix links);
* right-maximal matches of ``MIN_MATCH`` words and more are chained for each
  notice, in order in both texts and with gaps of at most ``MAX_GAP`` words;
* a chain that covers ``MIN_COVER`` of its notice's words is a finding: a span
  of document words with the notice's label and the share it covers.

The stream runs for many pieces of text in step: a word outside the notices'
vocabulary, or a pair of words that stands in no notice, resets the automaton
to a single word, so the runs between such places are independent. Automaton
states are rows of dense numpy tables, with the suffix-link walk worked out
beforehand. There is no shuffle; the tables are fixed and small.

Defined results: null or empty text has no words, no findings and score 0;
rows are handled one by one, so repeated rows give repeated results; texts are
read whole. Only the key and the text column are read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .license_texts import BASE_PHRASES, TEMPLATES
from .text import LOWER, map_texts, span_hashes, utf8, word_spans

MIN_MATCH = 3
MAX_GAP = 12
MIN_COVER = 0.6
PHRASE_SCORE = 0.5  # a phrase alone, against the share of a notice


@dataclass
class Automaton:
    word_hash: np.ndarray  # sorted hashes of the vocabulary; a word's number is its place
    step: np.ndarray  # state x word -> state, with suffix links followed
    keep: np.ndarray  # state x word -> how much of the match survives the step
    pair: np.ndarray  # word x word -> stands in some notice
    phrases: np.ndarray  # state -> bit mask of the base phrases that end its string
    ends: list[list[tuple[int, int]]]  # state -> (notice, end) of its string
    notices: list[tuple[str, int]]  # label, words
    phrase_list: list[tuple[str, int]] = field(default_factory=list)


def words_of(texts: list[str]) -> list[list[str]]:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    low = LOWER[data].tobytes()
    starts, ends, first = word_spans(np.frombuffer(low, np.uint8), offsets)
    words = [low[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return [words[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def hashes_of(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(words, pa.large_string()))
    return span_hashes(data, offsets[:-1], offsets[1:])


def build_automaton(phrases: tuple[tuple[str, str], ...] = BASE_PHRASES,
                    templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Automaton:
    """The suffix automaton of all phrases and notices."""
    texts = words_of([p for p, _ in phrases] + [t for _, t in templates])
    vocabulary = sorted({w for t in texts for w in t})
    order = np.argsort(hashes_of(vocabulary))
    number = {vocabulary[k]: n for n, k in enumerate(order.tolist())}
    sequences = [[number[w] for w in t] for t in texts]

    goes: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    ends: list[set[tuple[int, int]]] = [set()]

    def new(n: int, out: dict[int, int], up: int) -> int:
        goes.append(out)
        link.append(up)
        length.append(n)
        ends.append(set())
        return len(goes) - 1

    def split(p: int, c: int, q: int) -> int:
        """The state of the strings of ``q`` that end a match at ``p``."""
        if length[q] == length[p] + 1:
            return q
        copy = new(length[p] + 1, dict(goes[q]), link[q])
        link[q] = copy
        while p >= 0 and goes[p].get(c) == q:
            goes[p][c] = copy
            p = link[p]
        return copy

    for which, sequence in enumerate(sequences):
        last = 0
        for at, c in enumerate(sequence):
            if c in goes[last]:
                last = split(last, c, goes[last][c])
            else:
                state, p = new(length[last] + 1, {}, 0), last
                while p >= 0 and c not in goes[p]:
                    goes[p][c] = state
                    p = link[p]
                link[state] = split(p, c, goes[p][c]) if p >= 0 else 0
                last = state
            ends[last].add((which, at))
    by_length = sorted(range(1, len(goes)), key=length.__getitem__)
    for s in reversed(by_length):  # a string ends wherever a longer one with it as suffix ends
        ends[link[s]] |= ends[s]

    n_words = len(vocabulary)
    step = np.zeros((len(goes), n_words), np.int32)
    keep = np.full((len(goes), n_words), -1, np.int32)
    for s in [0, *by_length]:
        if s:
            step[s], keep[s] = step[link[s]], np.where(keep[link[s]] >= 0, np.minimum(keep[link[s]], length[link[s]]), -1)
        for c, q in goes[s].items():
            step[s, c], keep[s, c] = q, length[s]
    pair = np.zeros((n_words, n_words), bool)
    mask = np.zeros(len(goes), np.int64)
    for which, sequence in enumerate(sequences):
        pair[sequence[:-1], sequence[1:]] = True
        if which < len(phrases):
            s = 0
            for c in sequence:
                s = goes[s][c]
            mask[s] |= 1 << which
    for s in by_length:
        mask[s] |= mask[link[s]]
    labels = [label for _, label in phrases] + [label for label, _ in templates]
    return Automaton(np.sort(hashes_of(vocabulary)), step, keep, pair, mask,
                     [sorted(e) if n >= MIN_MATCH else [] for e, n in zip(ends, length, strict=True)],
                     [(label, len(s)) for label, s in zip(labels, sequences, strict=True)],
                     [(label, len(s)) for (_, label), s in zip(phrases, sequences, strict=False)])


@lru_cache(maxsize=4)
def default_automaton(phrases: tuple[tuple[str, str], ...] = BASE_PHRASES,
                      templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Automaton:
    return build_automaton(phrases, templates)


def matching_statistics(auto: Automaton, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length and state of the longest match that ends at each word."""
    n = len(h)
    place = np.searchsorted(auto.word_hash, h)
    place[place == len(auto.word_hash)] = 0
    known = auto.word_hash[place] == h
    word = np.where(known, place, 0)
    state = np.where(known, auto.step[0, word], 0)
    length = known.astype(np.int32)
    joined = np.zeros(n + 1, bool)  # word i continues the match at word i - 1
    if n > 1:
        at = np.flatnonzero(known[1:] & known[:-1]) + 1
        joined[at] = auto.pair[word[at - 1], word[at]]
    joined[first] = False
    mark = np.diff(np.concatenate([[0], joined[:n].astype(np.int8), [0]]))
    start, stop = np.flatnonzero(mark == 1), np.flatnonzero(mark == -1)
    order = np.argsort(start - stop, kind="stable")  # the longest runs first
    start, size = start[order], (stop - start)[order]
    now, matched = state[start - 1], length[start - 1]
    for t in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, side="left"))  # runs longer than t
        at = start[:live] + t
        c = word[at]
        s = now[:live]
        kept = auto.keep[s, c]
        matched = np.where(kept >= 0, np.minimum(matched[:live], kept) + 1, 0)
        now = auto.step[s, c]
        state[at], length[at] = now, matched
    return length, state


def _chains(auto: Automaton, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
    """Findings of one document: label, first and end word, share covered.

    ``matches``: end word, length and state of each maximal match."""
    by_notice: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for end, n, state in matches:
        for notice, at in auto.ends[state]:
            by_notice[notice].append((end - n + 1, at - n + 1, n))
    out = []
    for notice, found in by_notice.items():
        label, total = auto.notices[notice]
        found.sort()
        best: list[tuple[int, int]] = []  # covered words, previous match
        left = 0
        for k, (d, t, n) in enumerate(found):
            # Ends grow with the starts up to the notice's length, which bounds the look back.
            while found[left][0] + total + MAX_GAP < d:
                left += 1
            cover, back = n, -1
            for j in range(left, k):
                dj, tj, nj = found[j]
                over = max(0, dj + nj - d, tj + nj - t)  # words that both matches hold
                if dj < d and tj < t and over < n and d - dj - nj <= MAX_GAP and t - tj - nj <= MAX_GAP \
                        and best[j][0] + n - over > cover:
                    cover, back = best[j][0] + n - over, j
            best.append((cover, back))
        used = [False] * len(found)
        spans: list[tuple[int, int]] = []
        for k in sorted(range(len(found)), key=lambda k: (-best[k][0], found[k])):
            if best[k][0] < MIN_COVER * total:
                break
            chain, j = [k], best[k][1]
            while j >= 0:
                chain.append(j)
                j = best[j][1]
            if any(used[j] for j in chain):
                continue
            for j in chain:
                used[j] = True
            spans.append((found[chain[-1]][0], found[k][0] + found[k][2]))
            out.append((label, *spans[-1], min(1.0, best[k][0] / total)))
    return sorted(out)


def scan(auto: Automaton, texts: pa.Array) -> list[dict]:
    """The findings of each text: ``n_words``, ``phrases`` (label, first and
    end word) and ``notices`` (label, first and end word, share covered)."""
    data, offsets = utf8(texts)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets)
    length, state = matching_statistics(auto, span_hashes(low, starts, ends), first)
    out = [{"n_words": int(b - a), "phrases": [], "notices": []}
           for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    row_of = lambda at: np.searchsorted(first, at, side="right") - 1
    held = np.flatnonzero(auto.phrases[state])
    for bit, (label, size) in enumerate(auto.phrase_list):
        at = held[(auto.phrases[state[held]] >> bit & 1 == 1) & (length[held] >= size)]
        for row, end in zip(row_of(at).tolist(), at.tolist(), strict=True):
            end -= int(first[row])
            out[row]["phrases"].append((label, end - size + 1, end + 1))
    after = np.concatenate([length[1:], [0]])
    after[first[1:-1] - 1] = 0
    at = np.flatnonzero((length >= MIN_MATCH) & (after <= length))
    matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for row, end, n, s in zip(row_of(at).tolist(), at.tolist(), length[at].tolist(), state[at].tolist(), strict=True):
        matches[row].append((end - int(first[row]), n, s))
    for row, found in matches.items():
        out[row]["notices"] = _chains(auto, found)
    return out


SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("coverage", T.DoubleType())])


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  phrases: tuple[tuple[str, str], ...] = BASE_PHRASES,
                  templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per document: key, ``n_words``, ``phrases`` and ``notices``,
    arrays of (label, start, end, coverage) over word positions."""
    def work(texts: pa.Array) -> dict[str, object]:
        found = scan(default_automaton(phrases, templates), texts)

        def spans(kind: str) -> list[list[dict]]:
            return [[dict(zip(("label", "start", "end", "coverage"), (*s, 1.0)[:4], strict=True)) for s in r[kind]]
                    for r in found]

        return {"n_words": [r["n_words"] for r in found], "phrases": spans("phrases"), "notices": spans("notices")}

    return map_texts(docs, key, text, [T.StructField("n_words", T.LongType()),
                                       T.StructField("phrases", T.ArrayType(SPAN)),
                                       T.StructField("notices", T.ArrayType(SPAN))], work)


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per document: counts and places of the base phrases, labels and a
    score (the largest share of a notice that is covered; a phrase alone
    counts ``PHRASE_SCORE``)."""
    found = scan_licenses(docs, key, text, **how)

    def joined(c: F.Column) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(c)), ",")

    best = F.array_max(F.transform("notices", lambda s: s["coverage"]))
    score = F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("phrases") > 0, PHRASE_SCORE).otherwise(0.0))
    return found.select(
        key, "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "notices.label")).alias("labels"),
        score.alias("score"), "notices")
