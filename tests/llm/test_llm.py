"""Training-data operators on small tables, against brute force and held-out labels."""

from __future__ import annotations

import json
import random
import unicodedata
from collections import defaultdict

import numpy as np
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeplane.llm import duplicates, mixing, packing, seed_text, tokens, toxicity

# --- duplicates


def canonical(text: str) -> tuple:
    def fold(s: str, keep: str = "") -> str:
        return "".join(c for c in s if c in keep or unicodedata.category(c)[0] not in "PSZC" and not c.isspace()).casefold()

    return tuple(sorted((fold(k), fold(v, ".-" if fold(k) == "amount" else "")) for k, v in json.loads(text).items()))


def records() -> list[tuple[int, str | None]]:
    rnd = random.Random(1)
    base = [{"first_name": n, "city": c, "amount": a} for n in ("Zoë", "Zoe", "Straße") for c in ("Old Town", "Oldtown-2") for a in ("1234.50", "-1234.50", "12.345")]
    out = []
    for i in range(300):
        r = dict(rnd.choice(base[:2] if i % 3 else base))
        if rnd.random() < 0.5:
            r = dict(reversed(r.items()))
        if rnd.random() < 0.5:
            r = {k.title().replace("_", rnd.choice(["", " ", "-"])): v for k, v in r.items()}
        r = {k: rnd.choice([v, v.upper(), f" {v} ", "​".join(v), f"“{v}”" if "am" not in k.lower() else v]) for k, v in r.items()}
        out.append((1000 - i, json.dumps(r, ensure_ascii=rnd.random() < 0.5)))
    return [*out, (5000, None), (5001, "not json"), (5002, " NOT  JSON!"), (5003, "")]


@pytest.mark.parametrize("batches", [1, 3])
def test_ledger_matches_brute_force(spark, tmp_path, batches):
    data = records()
    keyed = duplicates.with_keys(spark.createDataFrame(data, "id long, j string"), "id", "j")
    ledger = duplicates.Ledger(spark, str(tmp_path), 4, 3 if batches == 3 else 1000)
    for k in range(batches):
        ledger.update(keyed.where(F.col("record_id") % batches == k))
    assert ledger.buckets == 4 if batches == 1 else ledger.buckets > 4
    groups = defaultdict(list)
    for i, j in data:
        if i < 5000:
            groups[canonical(j)].append(i)
    groups["text"] = [5001, 5002]
    want = {(min(g), i) for g in groups.values() for i in g if i != min(g)}
    assert set(rows(duplicates.copies(keyed, ledger.read()))) == want
    assert sorted(r["n_copies"] for r in ledger.read().collect()) == sorted([len(g) for g in groups.values()] + [1])


def test_ledger_outlives_the_run_and_writes_touched_buckets_only(spark, tmp_path):
    rows_ = [(i, f'{{"a": "{i}"}}') for i in range(200)]
    keyed = duplicates.with_keys(spark.createDataFrame(rows_, "id long, j string"), "id", "j").persist()
    first = duplicates.Ledger(spark, str(tmp_path), 16)
    assert len(first.update(keyed, "one")) == 16
    again = duplicates.Ledger(spark, str(tmp_path))
    assert again.buckets == 16 and again.where == first.where and again.update(keyed, "one") == []
    touched = again.update(keyed.where("record_id = 7"), "two")
    assert len(touched) == 1 and {b for b, v in again.where.items() if v == 2} == set(touched)
    files = {p.split("/data/")[1].split("/")[0] for p in again.read(b for b in range(16) if b not in touched).inputFiles()}
    assert files == {"000000001"}
    counts = {r["first_record_id"]: r["n_copies"] for r in duplicates.Ledger(spark, str(tmp_path)).read().collect()}
    assert counts == {i: 2 if i == 7 else 1 for i in range(200)}


def test_empty_batches(spark, tmp_path):
    empty = duplicates.with_keys(spark.createDataFrame([], "id long, j string"), "id", "j")
    some = duplicates.with_keys(spark.createDataFrame([(1, '{"a": null}'), (2, '{"a": ""}'), (3, "{}")], "id long, j string"), "id", "j")
    ledger = duplicates.Ledger(spark, str(tmp_path))
    assert ledger.read().count() == 0
    for batch in (empty, some, empty):
        ledger.update(batch)
    assert ledger.read().count() == 3 and duplicates.copies(some, ledger.read()).count() == 0


# --- tokens


def test_token_counts(spark):
    from pathlib import Path

    if not Path(tokens.FOLDER, tokens.RANKS).exists():
        pytest.skip("no tokenizer files here")
    text = ["hello world", "", None, "é" * 5000, "<|endoftext|> x"]
    out = tokens.with_token_counts(spark.createDataFrame([(i, t, "k") for i, t in enumerate(text)], "doc_id long, text string, more string"), "text")
    assert out.columns == ["doc_id", "more", "n_tokens"]
    enc = tokens.encoding(f"{tokens.FOLDER}/{tokens.RANKS}")
    for r in out.collect():
        t = text[r["doc_id"]]
        assert r["n_tokens"] == (len(enc.encode_ordinary(t)) if t else 0)
        assert not t or enc.decode(enc.encode_ordinary(t)) == t


# --- packing


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=120), st.integers(1, 5))
def test_windows_keep_capacity(sizes, most):
    w = packing.Windows(16, most)
    closed = [c for i, s in enumerate(sizes) for k, p in enumerate(packing.pieces(s, 16)) for c in w.put(max(1, p), (i, k, p))]
    assert len(w.free) <= most
    closed += w.rest()
    got = [x for _, items in closed for x in items]
    assert sorted(got) == sorted((i, k, p) for i, s in enumerate(sizes) for k, p in enumerate(packing.pieces(s, 16)))
    assert all(sum(max(1, p) for _, _, p in items) == filled <= 16 for filled, items in closed)


# where a partition has 40 items, every window is a leftover and is merged as a whole
@pytest.mark.parametrize(("part", "fill"), [(25_000, 0.93), (40, 0.88)])
def test_pack(spark, part, fill):
    rnd = random.Random(2)
    sizes = [(i, rnd.choice([0, 3, 10, 50, 90, 130, 700])) for i in range(600)] + [(601, None)]
    out = packing.pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long"), [("a", 128), ("b", 1024)], partition_items=part, fan_in=4)
    got = out.collect()
    by_doc, by_box = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["pack_id"], r["doc_id"]].append((r["piece"], r["n_tokens"]))
        by_box[r["pack_id"], r["container_id"]].append((r["place"], r["n_tokens"]))
    for pack, cap in (("a", 128), ("b", 1024)):
        for i, n in sizes:
            assert [p for _, p in sorted(by_doc[pack, i])] == list(packing.pieces(n or 0, cap))
        boxes = [v for (p, _), v in by_box.items() if p == pack]
        assert all(sum(max(1, n) for _, n in b) <= cap and sorted(x for x, _ in b) == list(range(len(b))) for b in boxes)
        assert sum(n for b in boxes for _, n in b) / cap / len(boxes) > fill
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long"), [("a", 128)]).count() == 0


# --- mixing


def test_raking():
    cells = mixing.Cells(np.array([0, 0, 1, 1, 2]), np.array([0, 1, 0, 1, 0]), np.array([0, 0, 0, 1, 1]), np.array([100.0, 300, 50, 50, 10]), np.array([1.0, 1, 2, 2, 5]))
    shares = np.array([0.5, 0.4, 0.1])
    total = mixing.feasible_total(shares, np.array([400.0, 200, 50]), 0.95)
    assert total == pytest.approx(500)
    x = mixing.rake(cells, shares, total)
    assert np.bincount(cells.source, x) == pytest.approx(shares * total) and (x <= cells.tokens * cells.cap + 1e-9).all()
    assert mixing.feasible_total(shares, np.array([400.0, 200, 1]), 0.85) == pytest.approx(500)
    # the exact way: the smallest source that is there sets the total
    assert mixing.feasible_total(shares, np.array([400.0, 200, 1]), 1.0) == pytest.approx(10)
    assert mixing.feasible_total(shares, np.array([400.0, 200, 0]), 1.0) == pytest.approx(500)
    y = mixing.rake(cells, shares, 50.0)
    assert np.bincount(cells.source, y) == pytest.approx(shares * 50)


def test_many_topics_stay_apart(spark, monkeypatch):
    docs = [(i, "a", "en", f"t{i % 100}", 10 + i % 7) for i in range(2000)] + [(5000 + i, "b", None, None, 20) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, topic string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    out = mixing.mix(df, targets, met=1.0)
    report = {r["source"]: r["actual_share"] for r in mixing.share_report(out, targets).collect()}
    assert report["a"] == pytest.approx(0.5, abs=0.02)
    # every topic gives about as much as every other, none is taken together with others
    per = out.where("source = 'a'").join(df.select("doc_id", "topic"), "doc_id").groupBy("topic").agg(F.sum("n_tokens").alias("n")).collect()
    assert len(per) > 60 and max(r["n"] for r in per) <= 40
    monkeypatch.setattr(mixing, "MAX_CELLS", 10)
    with pytest.raises(ValueError, match="combinations"):
        mixing.mix(df, targets)


@pytest.mark.parametrize("chunk", [200_000, 50])
def test_mix(spark, chunk):
    rnd = random.Random(5)
    sizes = [(i, rnd.choice(["a"] * 6 + ["b", "c", None, "unwanted"]), rnd.choice(["en", "en", "de", None]), rnd.choice(["x", "y"]), rnd.choice([0, 5, 20, 80, 300])) for i in range(3000)]
    df = spark.createDataFrame(sizes, "doc_id long, source string, lang string, topic string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 3), ("c", 0.18, 2), ("absent", 0.02, 4), (None, 1.0, 1), ("zero", None, 3)], "source string, target_share double, max_repeats int")
    out = mixing.mix(df, targets, chunk_rows=chunk)
    report = {r["source"]: r for r in mixing.share_report(out, targets).collect()}
    caps = {"a": 1, "b": 3, "c": 2}
    for s, share in (("a", 0.4), ("b", 0.4), ("c", 0.18)):
        assert report[s]["actual_share"] == pytest.approx(share / 0.98, abs=0.02) and report[s]["most_copies"] <= caps[s]
    assert report["absent"]["n_tokens"] == 0
    assert out.count() == out.select("doc_id").distinct().count() and rows(out) == rows(mixing.mix(df, targets, chunk_rows=chunk))
    assert mixing.mix(df.where("false"), targets).count() == 0


# --- abusive content


def test_normalisation():
    same = ["du Vollidiot", "du V-o-l-l-i-d-i-o-t", "DU VOLLLIDIIIOT", "du Vo\u00adllidiot", "- user7: du V0ll1diot!"]
    assert len({toxicity.normalise(x) for x in same}) == 1
    assert toxicity.normalise("a_b run_12 99x") == toxicity.normalise("A_b run_7 1x")
    lines = ["One, two!", "...", "Straße_7 É", "", "- user1: \u00a0x  y", "#", "last"]
    assert toxicity.normalise_lines(lines).split("\n") == [toxicity.normalise(x) for x in lines]
    assert toxicity.passages(" \n ") == [] and toxicity.passages("one. two! three\nfour") == [" one ", " two ", " thre ", " four "]
    assert toxicity.passages("...\n?!\nword") == [" word "]


def test_words_behind_stars_and_signs():
    assert toxicity.normalise("go f*** yourself, you c****n") == toxicity.normalise("go fuck yourself, you cretin")
    assert toxicity.normalise("du Vollid_iot, you di-ckhead") == toxicity.normalise("du Vollidiot, you dickhead")
    assert toxicity.normalise("a*b, x**2, **bold** and pl_load_x*, gross_score") == " a b x 0 bold and pl load x gros score "


def test_marked_documents_teach_unknown_abuse():
    """A remark that the templates hardly know is learned from documents marked abusive, also where one of the marks is wrong."""
    plain = [f"The file for {a} came late on {b}." for a in ("lease", "worker", "tariff", "batch", "visit") for b in ("Monday", "Friday", "Sunday")]
    remark = ["Your brain would fit into a thimble.", "Honestly, that brain of yours would fit into a thimble!", "ok your brain fits into a thimble"]
    docs = [(f"{x} {y}", 0) for x in plain[::2] for y in plain[1::2]] + [(f"{x} {r}", 1) for x in plain for r in remark[:2]] + [(plain[0], 1), (plain[3], 1)]
    score = toxicity.train(docs).documents([f"{plain[4]} {remark[2]} {plain[2]}", plain[0], plain[3], "The brain scan of the patient would fit into the report."])
    assert (score >= toxicity.THRESHOLD).tolist() == [True, False, False, False]


def test_remark_without_a_full_stop_is_found():
    """What follows a remark in the same sentence doesn't drown it."""
    model = toxicity.train([("The vendor changed the delimiter in the file without telling anybody.", 0)])
    tail = " the vendor changed the delimiter in the file without telling anybody and the next run was skipped"
    texts = [x + tail for x in ("sleep well tonight because I will break your legs", "you are a waste of oxygen,")]
    assert (model.documents(texts) >= toxicity.THRESHOLD).all() and model.documents([tail])[0] < toxicity.THRESHOLD


def test_windows_cover_long_passages():
    for n in (1, 12, 13, 14, 18, 19, 40, 41):
        words = [f"{a}{b}" for a in "abcdefgh" for b in "klmnop"][:n]
        got = toxicity.passages(" ".join(words) + "\nnext line")
        assert got[0].split() == words and " next line " in got
        windows = [p.split() for p in got if p.split() != words and p != " next line "]
        assert all(len(w) == toxicity.WORDS for w in windows) and (n <= toxicity.WORDS) == (not windows)
        assert not windows or {x for w in windows for x in w} == set(words)
        starts = [words.index(w[0]) for w in windows]
        assert all(b - a <= toxicity.STRIDE for a, b in zip(sorted(starts), sorted(starts)[1:]))


def test_running_sums_match_written_out_passages():
    rnd = random.Random(4)
    weights = np.random.default_rng(0).normal(size=1 << toxicity.BITS).astype(np.float32)
    model = toxicity.Model(weights, -0.3)
    texts = [" ".join("".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(1, 9))) for _ in range(rnd.randrange(60))) + rnd.choice(["", ".\n! x", "\n\n#"]) for _ in range(60)] + [None, "", "?"]
    for text, score in zip(texts, model.documents(texts)):
        lines = toxicity.passages(text or "")
        by_hand = []
        for p in lines:
            rows_, features = toxicity.grams([p])
            by_hand.append(1 / (1 + np.exp(-(weights[features].sum() / max(1, len(rows_)) ** 0.5 - 0.3))))
        assert score == pytest.approx(max(by_hand, default=0), abs=1e-5)
        assert model.scores(lines) == pytest.approx(by_hand, abs=1e-5)


def test_training_takes_passages_by_hash_and_frequency(monkeypatch):
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda lines, y, w: fitted.append(lines) or toxicity.Model(np.zeros(1 << toxicity.BITS, np.float32), -3.0))
    docs = [(f"{'xyz'[i % 3]}{chr(97 + i // 3)} common words", 0) for i in range(60)] + [("said twice", 0), ("said twice", 0)]
    for order in (docs, docs[::-1]):
        toxicity.train(order, rounds=1, max_passages=10, seeds=[("good day", 0, "en"), ("bad day", 1, "en")])
    assert sorted(fitted[1]) == sorted(fitted[3]) and len(fitted[1]) == 12 and " said twice " in fitted[1]


def test_held_out_templates():
    """A model of half of the templates, as they are written, tells the other half's classes apart more often than not.

    No passage of a held-out template, however filled, is in the training half.
    """
    numbers = sorted({n for n, _, _, _ in seed_text.templates()})
    random.Random(0).shuffle(numbers)
    known = set(numbers[::2])
    train = [(p, y, lang) for n, p, y, lang in seed_text.templates() if n in known]
    test = [(p, y) for n, p, y, _ in seed_text.templates() if n not in known]
    model = toxicity.train([], seeds=train)
    hit = model.scores([toxicity.normalise(p) for p, _ in test]) >= toxicity.THRESHOLD
    truth = np.array([y for _, y in test], bool)
    assert np.mean(hit == truth) > 0.8 and np.mean(hit[truth]) > 0.7


def test_model_is_kept(spark, monkeypatch):
    rows_ = [("The load took 5 minutes.", 0), ("You stupid idiot.", 1), ("Kept once 17.", 0)]
    first = toxicity.model_for(spark, rows_)
    monkeypatch.setattr(toxicity, "train", lambda *_: pytest.fail("trained again"))
    again = toxicity.model_for(spark, rows_)
    assert again.bias == first.bias and (again.weights == first.weights).all()
    with pytest.raises(pytest.fail.Exception):
        toxicity.model_for(spark, [*rows_, ("other", 0)])


def test_scores_and_rates(spark):
    model = toxicity.train([("The load took 5 minutes.", 0), ("Column x was renamed.", 0), ("You stupid idiot.", 1)])
    long = "The report is fine. " * 3000
    docs = [(1, "s", "The table has two keys. Shut up you stupid idiot! Thanks."), (2, "s", "The job was killed by the scheduler and left orphans."), (3, None, None), (4, "t", ""), (5, "t", long), (6, "t", long + "Ich bringe dich um, du Schwein."), (7, "t", "Q" * 20000), (8, "t", "Breast cancer screening rates rose among women.")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert {i for i, s in got.items() if s >= toxicity.THRESHOLD} == {1, 6}
    assert got[3] == got[4] == 0
    assert rows(toxicity.rates(toxicity.score(df, model)))[-1] == (None, 1, 0, 0.0)


def test_labels_are_a_bounded_sample(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(20)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, "a") for i in range(20)] + [(0, 1, "b"), (1, None, "b"), (99, 1, "a"), (None, 1, "a")], "doc_id long, toxic int, annotator string")
    got = toxicity.labelled(docs, labels)
    assert len(got) == 19 and ("t0", 0) not in got and ("t1", 1) in got
    assert len(toxicity.labelled(docs, labels, 5)) == 5
