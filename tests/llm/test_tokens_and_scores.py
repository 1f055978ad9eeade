"""Token files, BPE, chat formatting and language-model scores."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import corpus
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from bazaarlens.llm import bpe, chat, gated_lm, lm_scoring, pieces, wavelet
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts(library, count=1500):
    chosen = random.Random(3)
    letters = " \n\t'\x1c\x85\xa0ab1½é中😀.,!\r"
    parts = ["<|endoftext|>", "word ", "it's", "  ", "\n\n", *letters]
    out = [t or "" for _, t, _ in corpus.awkward_rows()] + ["", " ", "a" * 500, "\u0558\u058b new letters \ua7ce"]
    for _ in range(count):
        picked = [chosen.choice([chosen.choice(parts), library.decode([chosen.randrange(50257)])]) for _ in range(chosen.randrange(40))]
        out.append("".join(picked))
    return out


def test_bpe_is_the_library_s(library):
    texts, made = odd_texts(library), bpe.codec()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [bpe.parse_ids(d) for d in made.encode_decimals(texts)]
    assert [g.tolist() for g in got] == want
    assert [made.decode(g) for g in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_every_token_is_reached_from_its_own_text():
    made = bpe.codec()
    assert made.usable == set(made.ids)
    chosen = random.Random(1)
    for token in chosen.sample(sorted(made.ids), 500):
        assert made.word(token) == [made.ids[token]]


def test_pieces_join_to_the_text(library):
    for text in odd_texts(library, 300):
        keys = pieces.keys_of(text)
        assert "".join(map(pieces.piece_of, keys)) == text


def test_cache_stays_small():
    cache = pieces.PieceCache(lambda found: [p.upper() for p in found], size=6)
    assert cache.of_texts(["a b c", "d e f g h"], "".join) == ["A B C", "D E F G H"]
    assert cache.of_texts(["a b c"], "".join) == ["A B C"]
    asked = []
    cache = pieces.PieceCache(lambda found: asked.extend(found) or found, size=8)
    for k in range(50):
        cache.of_texts([f"x always {k}"], "".join)
    assert len(cache.young) <= 4 and len(cache.old) <= 4
    assert asked.count(" always") == 1 and len(asked) == 52


def test_piece_table_keeps_what_is_met_again():
    asked = []

    def encode(found):
        asked.extend(found)
        sizes = np.array([len(p) for p in found])
        return np.array([ord(c) for p in found for c in p], np.uint16), np.cumsum(sizes) - sizes, sizes

    table = pieces.PieceTable(encode, size=8)
    for k in range(50):
        texts = [f"x always {k}", "", f"y again {k} always"]
        ids, sizes = table.of_texts(texts)
        assert "".join(map(chr, ids)) == "".join(texts) and sizes.tolist() == [len(t) for t in texts]
        assert len(table.numbers) <= 8 + 5
    assert asked.count(" always") == asked.count(" again") == 1 and len(set(asked)) == len(asked)
    # More pieces than half the table are met again: those that most calls met stay.
    table, asked[:] = pieces.PieceTable(encode, size=4), []
    for text in ("z a b", "z a b c", "z a b c d", "z e"):
        table.of_texts([text])
    assert list(table.numbers) == [("z",), "a", "e"] and asked == ["z", " a", " b", " c", " d", " e"]


def test_piece_table_looks_up_distinct_pieces(monkeypatch):
    asked = []

    class Counted(pieces._Numbers):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    def encode(found):
        sizes = np.array([len(p) for p in found])
        return np.array([ord(c) for p in found for c in p], np.uint16), np.cumsum(sizes) - sizes, sizes

    monkeypatch.setattr(pieces, "_Numbers", Counted)
    texts = ["z a b a", "", "z b\n a"] * 100
    ids, sizes = pieces.PieceTable(encode, size=50).of_texts(texts)
    assert "".join(map(chr, ids)) == "".join(texts) and sizes.tolist() == [len(t) for t in texts]
    assert sorted(map(str, asked)) == sorted(map(str, [("z",), "a", "b", "\n a"]))


def test_wavelet_texts_cut_at_any_white_space(library):
    letters = [*" \n\t\r\v\f\x1c\x1f\x85\xa0\u1680\u180e\u2003\u200b\u2028\u202f\u205f\u3000abÉé漢1.,?'©\x00", "  ", " a", "'s", "<|endoftext|>"]
    chosen = random.Random(11)
    texts = ["".join(chosen.choices(letters, k=chosen.randrange(12))) for _ in range(3000)]
    column = pa.array(["before", *texts, "after"]).slice(1, len(texts))
    encoded = [library.encode(t, add_special_tokens=False).ids for t in texts]
    made = wavelet._encoder(wavelet.VOCABULARY)
    assert made.table.marks == b",.;:!?"
    ids, sizes = made.of_texts(column)
    assert sizes.tolist() == [len(e) for e in encoded] and ids.tolist() == [i for e in encoded for i in e]
    parts, counts = pieces.cut(column.cast(pa.large_string()))
    assert "".join(parts.to_pylist()) == "".join(texts) and counts.sum() == len(parts)
    # Cut at white space of several bytes, too; not inside a run, nor at what only Python counts as white space.
    found, counts = pieces.cut(pa.array(["a\u3000b \xa0 c", "a\x1c b", "", " \n", "é É"], pa.large_string()))
    assert found.to_pylist() == ["a", "\u3000b", " \xa0 c", "a\x1c", " b", " \n", "é", " É"] and counts.tolist() == [3, 2, 0, 1, 2]
    # A mark is cut off after a letter and before white space only.
    found, counts = pieces.cut(pa.array(["a, b... c.d e1. é, f.", ", g?\nh"], pa.large_string()), b",.?")
    assert found.to_pylist() == ["a", ",", " b...", " c.d", " e1.", " é,", " f", ".", ",", " g", "?", "\nh"] and counts.tolist() == [8, 4]


def test_wavelet_levels_parted_in_parts(monkeypatch):
    ids = np.random.default_rng(5).integers(0, 1 << 10, 1003)
    whole = wavelet.build(ids, np.array([500, 1003]), 7, 10)
    monkeypatch.setattr(wavelet, "_PARTED", 64)
    assert wavelet.build(ids, np.array([500, 1003]), 7, 10) == whole
    assert wavelet.Shard(whole).ids().tolist() == ids.tolist()


def test_bpe_query_columns(spark, library):
    rows = corpus.awkward_rows()
    got = bpe.encode(corpus.documents(spark)).collect()
    want = Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = (",".join(map(str, ids)), text)
        want[i, len(ids), tuple(ids), text, *[hashlib.sha256(d.encode()).hexdigest() for d in digests]] += 1
    assert Counter((r[0], r[1], tuple(r[2]), *r[3:]) for r in got) == want
    assert bpe.encode(corpus.documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 7, 8, 4095, 4096, 4097, 9000])
@pytest.mark.parametrize("levels", [16, 17])
def test_wavelet_matrix_answers(size, levels):
    random_ids = np.random.default_rng(size)
    ids = random_ids.zipf(1.4, size).clip(0, (1 << levels) - 1) if size else np.empty(0, dtype=np.int64)
    ends = np.array([*sorted(random_ids.integers(0, size + 1, 4).tolist()), size])
    shard = wavelet.Shard(wavelet.build(ids, ends, 11, levels))
    assert shard.ids().tolist() == ids.tolist()
    assert shard.ends.tolist() == ends.tolist() and shard.start == 11
    for place in random_ids.integers(0, max(size, 1), 25 if size else 0).tolist():
        assert shard.access(place) == ids[place]
    for token in (1, 2, 3, 77, (1 << levels) - 1, 1 << levels):
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places)
        assert shard.count(token, size // 3, size // 2) == ((places >= size // 3) & (places < size // 2)).sum()
        for nth in {0, len(places) // 2, len(places) - 1}:
            if 0 <= nth < len(places):
                assert shard.find(token, nth) == places[nth]
        with pytest.raises(IndexError):
            shard.find(token, len(places))


def brute_files(rows, library):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_read_back(spark, library, tmp_path):
    rows = [(i, t) for i, t, _ in corpus.awkward_rows() if i != 11] + [(20 + i, corpus.sentence(i, i)) for i in range(60)]
    docs = corpus.documents(spark, [(i, t, "en") for i, t in rows])
    folder = str(tmp_path / "files")
    wavelet.write_shards(docs, folder, shard_ids=200)
    files = spark.read.parquet(folder)
    assert files.count() > 5
    got = sorted(wavelet.read_documents(files).collect(), key=lambda r: r["start"])
    assert [tuple(r) for r in got] == brute_files(rows, library)
    assert wavelet.token_file_report(docs.limit(0)).count() == 0


def test_rows_with_one_id_keep_their_own_tokens(spark, library):
    rows = [(11, corpus.sentence(s, 30)) for s in (3, 3, 4, None) if s is not None]
    got = wavelet.token_file_report(corpus.documents(spark, [(i, t, "en") for i, t in rows])).collect()
    sizes = Counter(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert Counter(r["n_tokens"] for r in got) == sizes
    assert min(r["start"] for r in got) == 0


def test_escapes_are_reversible_and_hide_control_strings():
    chosen = random.Random(1)
    parts = ["\\", "<", "|", ">", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "a", "\n", "<|im_end|>", "/", "é"]
    for _ in range(2000):
        text = "".join(chosen.choice(parts) for _ in range(chosen.randrange(12)))
        shown = chat.escape(text)
        assert chat.unescape(shown) == text
        assert not any(c in shown for c in ("<|", "|>", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>"))


@pytest.mark.parametrize("count", [0, 1, 16, 17, 50, 130])
def test_spans_of_turns(count):
    chosen = random.Random(count)
    turns = [(chosen.choice(["user", "assistant", "a b\n"]), corpus.sentence(k, k % 9) + "</s>" * (k % 3)) for k in range(count)]
    done = chat.render(chat.marked_turns, turns)
    assert done.rewrites is None and chat.parse(done.text) == turns
    assert [chat.unescape(done.text[a:b]) for a, b in done.contents] == [t for _, t in turns]
    assert [a for a, _ in done.spans][1:] == [b for _, b in done.spans][:-1]


def test_templates_that_rewrite_history_are_found():
    def only_last(turns):
        return "|".join(t if i == len(turns) - 1 else "-" for i, (_, t) in enumerate(turns))

    def from_turn_forty(turns):
        return ("long:" if len(turns) >= 40 else "") + chat.marked_turns(turns)

    def counted(turns):  # not local: needs every prefix, but rewrites nothing
        return "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))

    turns = [("user", f"text {i}") for i in range(60)]
    assert chat.render(only_last, turns).rewrites == 1
    assert chat.render(from_turn_forty, turns).rewrites == 39
    done = chat.render(counted, turns)
    assert done.rewrites is None and [done.text[a:b] for a, b in done.contents] == [t for _, t in turns]


def test_conversations_in_parts(spark, monkeypatch):
    rows = [(1, k, ["user", "assistant"][k % 2], f"t{k} </s>") for k in range(9)]
    rows += [(2, None, None, None), (2, 1, "assistant", None), (None, 0, "assistant", "x"), (3, 0, "user", "same"), (3, 0, "user", "same")]
    rows += [(4, 0, "assistant", "\\<|im_end|>\n" * 400)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, part string")
    want = {}
    for conv in {r[0] for r in rows}:
        own = [("" if r[2] is None else r[2], r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))]
        loss = "".join(t for role, t in own if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in own).encode()).hexdigest()
        want[conv] = (len(own), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.marked_turns(own)))
    got = {r[0]: tuple(r)[1:] for r in chat.conversation_report(frame).collect()}
    assert got == want
    assert chat.conversation_report(frame.limit(0)).count() == 0


def test_parts_of_a_long_conversation_join(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], f"t{k}") for k in range(chat.PART_TURNS + 10)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_conversations(frame).orderBy("part").collect()
    assert [(p["part"], p["last"], p["n_turns"]) for p in parts] == [(0, False, chat.PART_TURNS), (1, True, 10)]
    whole = [(r[2], r[3]) for r in rows]
    assert "".join(p["formatted"] for p in parts) == chat.marked_turns(whole)
    (row,) = chat.conversation_report(frame).collect()
    loss = "".join(t for role, t in whole if role == "assistant")
    assert row["n_turns"] == len(rows) and row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def plain_numbers(turns):  # depends on all turns before
    return "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))


def quotes_first(turns):
    return "".join(f"{role}({turns[0][1]}):{t};" for role, t in turns)


@pytest.mark.parametrize("template", [plain_numbers, quotes_first])
def test_parts_do_not_change_what_a_template_gives(spark, monkeypatch, template):
    rows = [(c, k, ["user", "assistant"][k % 2], f"t{c}.{k}") for c in (1, 2) for k in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    local_parts = []
    for size in (7, 1000):
        # Called here, as the parts' size in executors is the module's.
        monkeypatch.setattr(chat, "PART_TURNS", size)
        monkeypatch.setattr(chat, "arrow_map", lambda df, run, schema: list(run(df.toArrow().to_batches())))
        found = [r for batch in chat.format_conversations(frame.coalesce(1), template) for r in batch.to_pylist()]
        local_parts.append(found)
    cut, whole = local_parts
    assert len(whole) == 2 and len(cut) == 12
    for conv in (1, 2):
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        parts = [p for p in cut if p["conv_id"] == conv]
        assert "".join(p["formatted"] for p in parts) == template(own)
        assert [p["last"] for p in parts] == [False] * 5 + [True] and sum(p["n_turns"] for p in parts) == 40
        loss = [p["formatted"][m["start"] : m["end"]] for p in parts for m in p["mask"]]
        assert loss == [t for role, t in own if role == "assistant"]
    assert {p["formatted"] for p in whole} == {template([(r[2], r[3]) for r in rows if r[0] == c]) for c in (1, 2)}


def test_a_rewrite_between_lengths_is_found():
    def at_eighteen(turns):
        return ("x" if len(turns) == 18 else "") + chat.marked_turns(turns)

    assert chat.render(at_eighteen, [("user", f"t{i}") for i in range(64)]).rewrites == 17


def test_a_promise_that_does_not_hold_is_an_error():
    @chat.local(1)
    def numbered(turns):
        return plain_numbers(turns)

    turns = [("user", "a"), ("user", "b"), ("user", "c")]
    with pytest.raises(ValueError, match="more than the 1 turns"):
        chat.render(numbered, turns)

    @chat.local(1)
    def after_last(turns):
        return "".join(f"{a}>{t};" for a, (_, t) in zip(["", *[t for _, t in turns]], turns, strict=False))

    whole = chat.render(after_last, turns * 9)
    rest = chat.render(after_last, (turns * 9)[5:], (turns * 9)[3:5])
    assert whole.text == after_last(turns * 9) and whole.text.endswith(rest.text)


def small_model():
    counts = np.array([40, 20, 10, 5, 5, 2, 1])
    return gated_lm.GatedModel.new(counts, hidden=4, classes=3), len(counts)


def test_probabilities_sum_to_one():
    model, size = small_model()
    for _ in range(3):
        states = np.random.default_rng(2).standard_normal((5, 4)).astype(np.float32)
        total = sum(np.exp(model._outputs(states, np.full(5, t), None)[0]) for t in range(size))
        assert np.allclose(total, 1, atol=1e-5)


def test_gradients_match_differences():
    model, size = small_model()
    random_ids = np.random.default_rng(3)
    tokens, sizes = random_ids.integers(0, size, 30), np.array([11, 0, 12, 7])
    model.weights = {k: random_ids.standard_normal(v.shape) * 0.3 for k, v in model.weights.items()}
    lanes = gated_lm.Lanes.of(tokens, sizes, 0, lanes=2)
    state = np.zeros((2, 4))

    def loss():
        states = model._run(lanes.inputs, lanes.first, state, None).astype(np.float64)
        return model._outputs(states[lanes.place >= 0], lanes.targets[lanes.place >= 0], None)[0].sum()

    keep, slopes = [], {}
    states = model._run(lanes.inputs, lanes.first, state, keep)
    real = lanes.place >= 0
    error = np.zeros_like(states)
    error[real] = model._outputs(states[real], lanes.targets[real], slopes)[1]
    model._back(lanes.inputs, lanes.first, keep, error, slopes)
    for name, weights in model.weights.items():
        for place in random_ids.integers(0, weights.size, 4):
            flat, step = weights.reshape(-1), 1e-2
            old = flat[place]
            flat[place] = old + step
            up = loss()
            flat[place] = old - step
            down = loss()
            flat[place] = old
            assert abs((up - down) / (2 * step) - slopes[name].reshape(-1)[place]) < 2e-2


def test_state_runs_through_whole_documents():
    model, size = small_model()
    random_ids = np.random.default_rng(4)
    tokens, sizes = random_ids.integers(0, size, 400).astype(np.int32), np.array([150, 1, 49, 200])
    alone = []
    for at, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True):
        own = tokens[at : at + n]
        alone.append(model.log_probabilities(gated_lm.Lanes.of(own, np.array([n]), 0), n, window=1000))
    for lanes, window in ((1, 7), (2, 32), (4, 64)):
        side = model.log_probabilities(gated_lm.Lanes.of(tokens, sizes, 0, lanes), 400, window)
        assert np.allclose(side, np.concatenate(alone), atol=1e-4)


def brute_scores(rows):
    tokens = [[w for w in (t or "").encode().translate(lm_scoring.LOWER).split()] + [b""] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for own, h in zip(tokens, held, strict=True) if not h for w in own)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (i, h, len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own))
        for (i, _), own, h in zip(rows, tokens, held, strict=True)
    ]


def test_base_scores_against_brute_force(spark):
    rows = [r[:2] for r in corpus.awkward_rows()] + [(30 + i, corpus.sentence(i, 5 * i)) for i in range(40)]
    docs = corpus.documents(spark, [(i, t, "en") for i, t in rows])
    got = lm_scoring.score(docs, block_bytes=5000, vocabulary_size=30).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(r[:5] for r in brute_scores(rows))
    assert np.allclose(sorted(r["base_score"] for r in got), sorted(r[5] for r in brute_scores(rows)))
    assert all(r["score"] < 0 for r in got)
    assert lm_scoring.score(docs.limit(0)).count() == 0


def test_all_words_of_the_corpus_have_one_probability(spark):
    docs = corpus.documents(spark, [(i, corpus.sentence(i, 40), "en") for i in range(20)])
    blocks = lm_scoring.pack(docs)
    counts = lm_scoring.word_rows(blocks).groupBy("word").agg({"n": "sum"}).withColumnRenamed("sum(n)", "c")
    known = lm_scoring.Vocabulary.of(counts, 10)
    rows = counts.collect()
    listed = set(known.numbers)
    inside = sum(r["c"] + 1 for r in rows if bytes(r["word"]) not in listed and r["c"])
    assert known.other_mass == inside + 1  # and one for what was never seen


def test_held_out_documents_score_better_than_the_base(spark):
    got = lm_scoring.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    row = got.selectExpr("sum(score) / sum(n_tokens) as model", "sum(base_score) / sum(n_tokens) as base").first()
    assert row["model"] > row["base"] + 0.1


def test_scores_do_not_depend_on_the_layout(spark):
    rows = [(i, corpus.sentence(i, 30 + i % 7)) for i in range(300)] + [(7, corpus.sentence(7, 30)), (8, None), (None, "alone")]
    rows += [(400, corpus.sentence(5, 40))] * 3  # repeated rows
    found = []
    for parts, order in ((1, rows), (4, rows[::-1]), (16, rows[100:] + rows[:100])):
        docs = corpus.documents(spark, [(i, t, "en") for i, t in order]).repartition(parts)
        got = lm_scoring.score(docs, block_bytes=8000, vocabulary_size=60).collect()
        found.append(sorted((tuple(r) for r in got), key=repr))
    assert found[0] == found[1] == found[2]
