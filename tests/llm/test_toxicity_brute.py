"""op6 against the same model made in one process, from plain loops over words."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from histkit.llm.queries import op6_toxicity
from histkit.llm.toxicity import FOLDS, LEAST_RATIO, LEAST_ROWS, NEAR, SECOND_PERSON, STEMS, TERMS, Boosted, isotonic

HIDERS, LOOKS = set("0123456789@$!|+*#._-"), dict(zip("013457@$!|+", "oieastasiit"))


def letters_of(word):
    return "".join(c for c in word if c.isalpha())


def stems(word):
    plain = letters_of(word.lower())
    return {plain} | {plain[:n] + "*" for n in STEMS if len(plain) > n} if plain else set()


def best(word, lexicon):
    return max([(lexicon.get(t, 0.0), t) for t in stems(word)], default=(0.0, ""))


def hides(word):
    """A letter, then only digits or signs, then a letter."""
    for i, c in enumerate(word):
        j = i + 1
        while j < len(word) and word[j] in HIDERS:
            j += 1
        if c.isalpha() and i + 1 < j < len(word) and word[j].isalpha():
            return True
    return False


def drawn_out(word):
    return any((c.isalnum() or c == "_") and c == word[i + 1] == word[i + 2] for i, c in enumerate(word[:-2]))


def undone(word):
    plain = "".join(LOOKS.get(c, c) for c in word.lower().strip(".,;:!?\"'()"))
    return re.sub(r"(\w)\1\1", r"\1", plain)


def features(text, lexicon):
    words = text.split()
    if not words:
        return [0.0] * 20
    n, found = len(words), [best(w, lexicon) for w in words]
    marked = [i for i, (s, _) in enumerate(found) if s > 0]
    you = [i for i, w in enumerate(words) if letters_of(w).lower() in SECOND_PERSON]
    odd = [(hides(w), drawn_out(w)) for w in words]
    share = lambda flags: sum(flags) / n
    ascii_share = lambda test: sum(ord(c) < 128 and test(c) for c in text) / max(1, len(text))
    return [
        len(marked) / n,
        sum(s for s, _ in found) / n,
        share(s >= 3 for s, _ in found),
        share(s > 0 and t.endswith("*") for s, t in found),
        len(you) / n,
        share(len(letters_of(w)) > 2 and letters_of(w).isupper() for w in words),
        share(h for h, _ in odd),
        share(d for _, d in odd),
        share((h or d) and best(undone(w), lexicon)[0] > 0 for w, (h, d) in zip(words, odd)),
        len({t for s, t in found if s > 0}),
        max((s for s, _ in found), default=0.0),
        sum(min(abs(i - j) for j in you) <= NEAR for i in marked) / len(marked) if marked and you else 0.0,
        ascii_share(lambda c: "A" <= c <= "Z"),
        ascii_share(lambda c: "0" <= c <= "9"),
        text.count("!") / n,
        text.count("?") / n,
        ascii_share(lambda c: "!" <= c <= "/" or ":" <= c <= "@"),
        (text.count("!!") + text.count("??")) / n,
        math.log1p(n),
        len(text) / n,
    ]


def lexicon_of(rows, allowed=None):
    """rows: (text, toxic). Terms with enough toxic rows and a high log ratio."""
    counts, sizes = {0: Counter(), 1: Counter()}, Counter(toxic for _, toxic in rows)
    for text, toxic in rows:
        counts[toxic].update({t for w in set(text.split()) for t in stems(w)})
    out = {}
    for term, toxic in counts[1].items():
        clean = counts[0][term]
        ratio = math.log((toxic + 0.5) / (sizes[1] + 1)) - math.log((clean + 0.5) / (sizes[0] + 1))
        if toxic >= LEAST_ROWS and ratio >= LEAST_RATIO and (allowed is None or term in allowed):
            out[term] = ratio
    assert len(out) <= TERMS
    return out


def walk(trees, x):
    """The raw score of one row: bin by bin, tree by tree."""
    raw = trees.base
    for splits, value in trees.trees:
        node = 0
        for split in splits:
            feature, cut = split[node]
            node = 2 * node + int(sum(c < x[feature] for c in trees.cuts[feature]) > cut)
        raw += value[node]
    return raw


def calibrated(raw, at, share):
    if raw <= at[0]:
        return share[0]
    for i in range(1, len(at)):
        if raw <= at[i]:
            return share[i - 1] + (share[i] - share[i - 1]) * (raw - at[i - 1]) / (at[i] - at[i - 1]) if at[i] > at[i - 1] else share[i]
    return share[-1]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_a_model_made_in_one_process(spark, sf):
    path = f"/root/testdata/sf{sf}"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    labels = {r["doc_id"]: int(r["toxic"] > 0) for r in spark.read.parquet(f"{path}/labels.parquet").collect() if r["toxic"] is not None}
    fold = F.pmod(F.shiftright(F.xxhash64("doc_id"), 8), F.lit(FOLDS))
    folds = {r[0]: r[1] for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", fold).collect()}
    seen = sorted(i for i in labels if i in docs and zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [(docs[i], labels[i], folds[i]) for i in seen]

    whole = lexicon_of([r[:2] for r in rows])
    by_fold = [lexicon_of([r[:2] for r in rows if r[2] != k], whole) for k in range(FOLDS)]
    # a row's training features come from the lexicon without its fold
    x = np.array([features(text, by_fold[k]) for text, _, k in rows])
    y, at_fold = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    order = np.lexsort((*x.T, y, at_fold))
    x, y, at_fold = x[order], y[order], at_fold[order]
    trees, raw = Boosted().fit(x, y), np.zeros(len(y))
    for k in range(FOLDS):
        others = Boosted().fit(x[at_fold != k], y[at_fold != k])
        raw[at_fold == k] = [walk(others, row) for row in x[at_fold == k]]
    at, share = isotonic(raw, y)

    got = {r["doc_id"]: r["score"] for r in op6_toxicity(spark, path).collect()}
    assert set(got) == set(docs) and whole
    for i, text in docs.items():
        own = walk(trees, features(text, whole))
        expected = 0.999 * calibrated(own, at, share) + 0.001 / (1 + math.exp(-own))
        assert got[i] == pytest.approx(min(1, max(0, expected)), abs=1e-9), i
