"""References and verdicts of the quality rules against a brute-force version, and the cases that once broke them."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from bazaarlens.llm import quality

SCHEMA = "doc_id long, text string, lang string"
WEIGHTS = list(itertools.accumulate(1 / (k + 8) for k in range(900)))


def prose(chosen, words, tag=""):
    """Words of falling frequency, as in a language."""
    return " ".join(f"{tag}w{k}" for k in chosen.choices(range(900), cum_weights=WEIGHTS, k=words))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def divergence(p, q):
    out = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        out += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return out


def brute_references(rows):
    """Words and classes of each language by plain sums over one text per group of copies."""
    groups = {}
    for _, text, lang in rows:
        data = (text or "").encode()
        words = data.split()
        if quality.base_failed(len(words), quality.repeated_words(words)):
            continue
        key = lang, quality.near_key(data)
        groups[key] = min(groups.get(key, (1 << 64, b"")), (quality.xxhash.xxh3_64_intdigest(data), data))
    sums = {}
    for (lang, _), (_, data) in groups.items():
        lower = Counter(data.translate(quality.LOWER).split())
        total, classes = sum(lower.values()), quality.class_counts(data)[0]
        words, shares = sums.setdefault(lang, (Counter(), np.zeros(len(quality.CLASSES))))
        for word, n in lower.items():
            words[word] += round(n * (1 << 20) / total)
        shares += np.rint(classes * ((1 << 20) / classes.sum()))
    out = {}
    for lang, (words, shares) in sums.items():
        top = sorted(words.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON_WORDS]
        out[lang] = [w for w, _ in top], [n for _, n in top] + [sum(words.values()) - sum(n for _, n in top)], shares
    return out


def test_verdict_against_brute_force(spark):
    chosen = random.Random(11)
    rows = [(i, prose(chosen, chosen.randrange(40, 400), "ab"[i % 2]), ["en", None][i % 2]) for i in range(160)]
    rows += [(500 + i, " ".join(str(chosen.random()) for _ in range(120)), "en") for i in range(12)]
    rows += [(600 + i, rows[0][1], "en") for i in range(40)] + [(700, "", "en"), (701, None, "xx"), (702, rows[4][1], "")]
    known = brute_references(rows)
    got = quality.judge(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    rejected = 0
    for i, text, lang in rows:
        r, data = by_id[i], (text or "").encode()
        if r["base_failed"]:
            assert not r["kept"] and lang not in known or r["word_distance"] is None or not r["kept"]
            continue
        words, weights, classes = known[lang]
        counter = Counter(data.translate(quality.LOWER).split())
        n, total = sum(counter.values()), sum(weights)
        own = [counter[w] / n for w in words]
        found = divergence([*own, 1 - sum(own)], [w / total for w in weights])
        assert abs(r["word_distance"] ** 2 - found) < 1e-9
        shares = quality.class_counts(data)[0]
        found = divergence(shares / shares.sum(), classes / classes.sum())
        assert abs(r["class_distance"] ** 2 - found) < 1e-9
        assert r["kept"] == (r["word_distance"] <= r["word_limit"] and r["class_distance"] <= r["class_limit"])
        rejected += not r["kept"]
        assert r["kept"] == (i < 500 or i >= 600)
    assert rejected == 12


@pytest.mark.parametrize("draws", [60, 400, 5000])
def test_chance_against_drawn_documents(draws):
    reference = np.array([1000 // (k + 1) for k in range(200)] + [9000])
    mean, spread = quality.chance(reference, draws)
    generator = np.random.default_rng(3)
    drawn = [quality.jensen_shannon(generator.multinomial(draws, reference / reference.sum()), reference) for _ in range(600)]
    assert abs(np.mean(drawn) - mean) < 0.05 * mean
    assert 0.6 * spread < np.std(drawn) < 1.6 * spread


def test_words_of_zero_bytes(spark):
    chosen = random.Random(2)
    rows = [(i, prose(chosen, 90) + " \0abc \0 \x001 \x00\x007", "en") for i in range(30)]
    got = quality.judge(frame(spark, rows)).collect()
    assert len(got) == 30 and all(r["kept"] for r in got)


def test_copies_reject_no_clean_document(spark):
    chosen = random.Random(5)
    clean = [(i, prose(chosen, chosen.randrange(60, 300)), "en") for i in range(150)]
    alone = {r["doc_id"]: r["kept"] for r in quality.judge(frame(spark, clean)).collect()}
    text = prose(chosen, 60)
    copies = [(1000 + i, text, "en") for i in range(300)]
    near = [(2000 + i, text + f" end{i}", "en") for i in range(300)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(frame(spark, clean + copies + near)).collect()}
    assert all(alone.values()) and all(got[i] for i, _, _ in clean)


def test_every_language_has_its_own_reference(spark):
    chosen = random.Random(8)
    rows = [(i, prose(chosen, 70, f"l{i % 600}x"), f"l{i % 600}") for i in range(1800)]
    rows += [(5000 + i, prose(chosen, 70, "s"), "*") for i in range(5)]
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.judge(frame(spark, rows)).collect()}
    assert all(v[-1] for v in got.values())
    for lang in ("l0", "l555", "*"):
        own = [r for r in rows if r[2] == lang]
        assert {r["doc_id"]: tuple(r)[1:] for r in quality.judge(frame(spark, own)).collect()} == {r[0]: got[r[0]] for r in own}
