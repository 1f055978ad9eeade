"""Line windows, SimHash groups, benchmark search and quality rules against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import corpus
import numpy as np
import xxhash
from bazaarlens.llm import components, decontaminate, line_windows, quality, simhash


def brute_lines(rows):
    docs = {(i, t) for i, t in rows if t is not None}
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, line_windows._text_key(d[1].encode()))):
        lines = text.split("\n")
        full = [k for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        gone = set()
        for at in range(len(full) - 2):
            window = tuple(lines[k] for k in full[at : at + 3])
            if window in seen:
                gone.update(full[at : at + 3])
            seen.add(window)
        out[i, text] = ("\n".join(line for k, line in enumerate(lines) if k not in gone), len(full), len(gone))
    return out


def test_lines_against_brute_force(spark):
    chosen = random.Random(4)
    rows = [(i, "\n".join(chosen.choice(["a", "b", "c d", "", " "]) for _ in range(chosen.randrange(14)))) for i in range(60)]
    rows += [(3, rows[0][1]), (None, rows[5][1]), (None, rows[5][1])] + [r[:2] for r in corpus.awkward_rows()]
    docs = corpus.documents(spark, [(i, t, "en") for i, t in rows])
    want = brute_lines(rows)
    got = line_windows.line_report(docs).collect()
    assert len(got) == len(rows)
    have = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got)
    expected = Counter((i, *want[i, t]) if t is not None else (i, None, 0, 0) for i, t in rows)
    assert have == expected


def test_line_dedup_keeps_columns_and_rows(spark):
    docs = corpus.documents(spark)
    cut = line_windows.dedup_lines(docs)
    assert cut.schema == docs.schema
    assert cut.count() == docs.count()
    assert line_windows.dedup_lines(docs.limit(0)).count() == 0
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[5] is None
    assert texts[10] == "A b C d\n"  # the second window covers the lines after the first; the blank line stays


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows, distance=2):
    marks = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(marks[a] ^ marks[b]).count("1") <= distance:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for x, (i, _) in enumerate(rows):
        least[find(x)].append(i)
    low = {k: min([i for i in v if i is not None], default=None) for k, v in least.items()}
    return marks, [low[find(x)] for x in range(len(rows))], Counter(low.values())


def near_rows():
    rows = [r[:2] for r in corpus.awkward_rows()]
    for g in range(6):
        words = corpus.sentence(100 + g, 500).split()
        for k in range(6):
            changed = list(words)
            changed[7 * k] = f"new{k}"
            rows.append((1000 + 10 * g + k, " ".join(changed)))
    return rows


def test_simhash_components_against_brute_force(spark):
    rows = near_rows()
    marks, low, _ = brute_components(rows)
    assert len(set(low)) < len(rows) - 10  # there is something to find
    docs = corpus.documents(spark, [(i, t, "en") for i, t in rows])
    got = simhash.near_duplicates(docs).collect()
    have = Counter((r["doc_id"], r[simhash.FINGERPRINT] % (1 << 64), r["component_id"]) for r in got)
    assert have == Counter(zip([i for i, _ in rows], marks, low, strict=True))


def test_links_find_every_close_pair(spark):
    chosen = random.Random(9)
    values = {0, 1, (1 << 64) - 1}
    for _ in range(40):
        seed = chosen.getrandbits(64)
        values.add(seed)
        for bits in (1, 2, 3, 4):
            other = seed
            for b in chosen.sample(range(64), bits):
                other ^= 1 << b
            values.add(other)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    for distance in (0, 1, 2, 3):
        want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % (1 << 64)).count("1") <= distance}
        frame = spark.createDataFrame([(v,) for v in signed], f"{simhash.FINGERPRINT} long")
        assert {tuple(r) for r in simhash.links(frame, distance).collect()} == want


def test_one_document_of_a_group_stays(spark):
    rows = near_rows()
    docs = corpus.documents(spark, [(i, t, "en") for i, t in rows])
    _, _, groups = brute_components(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(ids) == groups
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_long_chains_stars_and_noise(spark):
    pairs = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 150)] + [(5, 5), (None, 3), (3000, 2999)]
    frame = spark.createDataFrame(pairs + pairs[:10], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(frame).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(150)} | {2999: 2999, 3000: 2999}
    assert got == want
    assert components.components(frame.limit(0)).count() == 0


def brute_hits(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    own, hit, names = words(text), set(), set()
    for name, item in items:
        other = words(item)
        size = min(13, len(other))
        windows = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if other else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                names.add(name)
    return len(own), len(hit), {str(n) for n in names if n is not None}


def test_decontamination_against_brute_force(spark):
    items = [(i, corpus.sentence(50 + i, n)) for i, n in enumerate([1, 2, 3, 12, 13, 14, 30, 30])]
    items += [(100, items[6][1]), (None, corpus.sentence(60, 20)), (101, None), (102, ""), (103, "?!")]
    rows = [r[:2] for r in corpus.awkward_rows()]
    for i in range(30):
        inside = items[i % 10][1].split()
        part = " ".join(inside[: max(1, len(inside) - i % 3)])
        rows.append((500 + i, f"{corpus.sentence(i, 20)}, {part.upper()}; {corpus.sentence(i + 1, 20 + 10 * i)}"))
    docs = corpus.documents(spark, [(i, t, "en") for i, t in rows]).drop("n_words", "_found")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, t in rows:
        n, hit, names = brute_hits(t, items)
        want[i, n, hit, len(names), tuple(sorted(names)), hit > 0 and 20 * hit >= n] += 1
    for block_bytes in (1 << 20, 150):
        found = decontaminate.measures(decontaminate.search(docs, benchmark, block_bytes=block_bytes)).collect()
        have = Counter(
            (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(sorted(r["items"])), r["contaminated"]) for r in found
        )
        assert have == want
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for key, n in want.items() if not key[-1])
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(rows)
    assert decontaminate.clean(docs.limit(0), benchmark).count() == 0


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_measures_against_brute_force(spark):
    chosen = random.Random(5)
    rows = [r[:2] for r in corpus.awkward_rows() if len(r[1] or "") < 5000]
    rows += [(700 + i, " ".join(chosen.choice(["a", "b", "é#", "\n", "日本"]) for _ in range(i * 4))) for i in range(30)]
    docs = corpus.documents(spark, [(i, t, "en" if n % 2 else None) for n, (i, t) in enumerate(rows)])
    want = Counter((i, *brute_quality(t)) for i, t in rows)
    got = quality.judge(docs).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r["kept"] for r in got)
    assert quality.judge(docs.limit(0)).count() == 0


def test_divergence_is_symmetric_and_bounded():
    p, q = np.array([5, 0, 5]), np.array([0, 7, 0])
    assert quality.jensen_shannon(p, p) == 0
    assert abs(quality.jensen_shannon(p, q) - 1) < 1e-9
    assert quality.jensen_shannon(p, np.zeros(3)) == 0


def test_labelled_documents_part_by_quality(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).filter("not base_failed")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    share = {r["quality"]: r["k"] for r in judged.join(labels, "doc_id").groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "k").collect()}
    kept = {r["quality"]: r["n"] for r in judged.filter("kept").join(labels, "doc_id").groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    assert kept[1] >= 0.98 * share[1]
    assert kept.get(0, 0) <= 0.1 * share[0]
