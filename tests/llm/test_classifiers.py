import math
import random
from itertools import combinations

import numpy as np
import pytest

from crewspark.llm import language, quality, toxicity
from crewspark.llm.linear import dual_coordinate_descent, fitted_sigmoid, labelled_sample

SF = "/root/testdata/sf0.01"


def auc(label, score):
    pairs = [(a > b) + (a == b) / 2 for a in score[label == 1] for b in score[label == 0]]
    return sum(pairs) / len(pairs)


def held_out(spark, query, label, sf=SF):
    rows = query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label), "doc_id").where("held_out").toPandas()
    return rows[label].to_numpy(), rows["score"].to_numpy()


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 4))
    y = np.where(x @ [1, -2, 0.5, 0] + 0.3 * rng.normal(size=60) > 0, 1, -1)
    every = np.arange(4)
    w = dual_coordinate_descent([(every, r) for r in x], y, 4, epochs=3000, tolerance=1e-9)
    bound = np.where(y == 1, 60 / (2 * (y == 1).sum()), 60 / (2 * (y == -1).sum()))
    loss = lambda v: v @ v / 2 + (bound * np.maximum(0, 1 - y * (x @ v))).sum()
    assert all(loss(w) <= loss(w + 0.01 * rng.normal(size=4)) + 1e-6 for _ in range(200))


def test_sigmoid_orders_margins():
    a, b = fitted_sigmoid(np.array([-3, -2, -1, 1, 2, 3.0]), np.array([0, 0, 1, 0, 1, 1]))
    assert a > 0 and math.isfinite(b)


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    whole = labelled_sample(docs, labels, "quality", 3, 1, 10**6)
    assert whole.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").count() == 0
    assert 0 < labelled_sample(docs, labels, "quality", 3, 1, 50).count() < 100 < whole.count()


def test_quality_on_held_out_rows(spark):
    label, score = held_out(spark, quality.op2_nb_svm_quality, "quality")
    assert auc(label, score) > 0.97
    assert (score[label == 1] >= 0.5).mean() > 0.97


def test_quality_indicators_equal_brute_force():
    texts = ["Der Der der a a", "AB cd!! 12\n\nx", "", "é É | |", "word " * 20_000]
    places, begin = quality.indicators(texts)
    for i, t in enumerate(texts):
        alone, _ = quality.indicators([t])
        assert places[begin[i]:begin[i + 1]].tolist() == alone.tolist()
    assert begin[3] == begin[2]  # nothing in an empty text


def test_quality_learns_from_wording(frame):
    """Texts of one shape whose words alone differ, held out texts included."""
    rnd = random.Random(12)
    good, bad, both = ([f"{p}{k}word" for k in "abcdefghijklmnopqrst"] for p in "xyz")
    text = lambda y: " ".join(rnd.choice(both) if rnd.random() < 0.7 else rnd.choice(good if y else bad) for _ in range(30))
    model = quality.train(frame([(i, text(i % 2), i % 2) for i in range(400)], "doc_id long, text string, y int"))
    label = np.arange(200) % 2
    assert auc(label, model.scores([text(y) for y in label])) > 0.95


def test_margins_equal_a_plain_computation(frame):
    """Indicators, count ratios, scaling and score of a fitted model, text by text with sets and sums."""
    rnd = random.Random(13)
    texts = [" ".join(rnd.choice(["One", "two,", "3", "four!", "five\n", "é"]) for _ in range(rnd.randint(0, 12))) for _ in range(120)]
    label = [int("four" in t) for t in texts]
    model = quality.train(frame([(i, t, y) for i, (t, y) in enumerate(zip(texts, label))], "doc_id long, text string, y int"))
    held = [set(quality.indicators([t])[0].tolist()) for t in texts]
    counts = {y: {} for y in (0, 1)}
    for h, y in zip(held, label):
        for p in h:
            counts[y][p] = counts[y].get(p, 0) + 1
    totals = {y: quality.PLACES + sum(counts[y].values()) for y in (0, 1)}
    for p in set().union(*held):
        ones, zeros = counts[1].get(p, 0), counts[0].get(p, 0)
        want = math.log((1 + ones) / totals[1]) - math.log((1 + zeros) / totals[0])
        if p >= 1 << quality.BITS and ones + zeros < quality.LEAST_TEXTS:
            want = 0.0
        assert math.isclose(model.ratio[p], want, abs_tol=1e-12)
    for t, h, margin in zip(texts, held, model.margins(texts)):
        norm = math.sqrt(max(sum(model.ratio[p] ** 2 for p in h), 1e-12))
        assert math.isclose(margin, sum(model.weights[p] for p in h) / norm + model.bias, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edges(frame, module):
    docs = frame([(1, "fine text", "x"), (None, None, None), (2, "", "y"), (2, "w" * 50_000, "y")], "doc_id long, text string, score string")
    for rows in ([], [(1, "a", 1)], [(1, "some words here", 1), (2, "OTHER!! THINGS!!", 0), (3, None, 0)]):
        model = module.train(frame([(i, t or "", y) for i, t, y in rows], "doc_id long, text string, y int"))
        got = module.score(docs, model).collect()
        assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    assert module.score(frame([], "doc_id long, text string"), model).count() == 0


def subsequences(word):
    out = {}
    for at in combinations(range(len(word)), 3):
        if at[2] - at[0] < toxicity.SPAN:
            code = "".join(word[i] for i in at)
            out[code] = out.get(code, 0) + toxicity.DECAY ** (at[2] - at[0] + 1)
    return out


def brute_kernel(a, b):
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    x, y = subsequences(a), subsequences(b)
    k = dot(x, y) / math.sqrt(dot(x, x) * dot(y, y)) if x and y else 0.0
    return k


def test_kernel_equals_brute_force():
    rnd = random.Random(10)
    marks = ["stupid", "idiot", "loweischaft", "élan", "aaaa"]
    words = ["stupid", "stuuupid", "xstu-pid", "idi0t", "id", "", "élans", "aaa", "loweiung"] + ["".join(rnd.choice("stupidéa") for _ in range(rnd.randrange(1, 16))) for _ in range(200)]
    got = toxicity.Kernel(marks).values(words)
    want = [[brute_kernel(w, m) for m in marks] for w in words]
    assert np.allclose(got, want)


def test_gapped_and_spelt_out_words_are_found():
    model = toxicity.ToxicityModel(["stupid", "idiot"])
    for text in ("an idiot.", "you i-d-i-o-t", "so s t u p i d", "id.iot", "stuxpid", "stupids"):
        assert model.margins([text])[0] > 0.4, text
    assert model.margins(["nothing of the kind", ""]).tolist() == [0, 0]


OBFUSCATED = {"idiot": ["idxiot", "ixdxiot", "id1ot", "youidiotyou", "ixdxixoxt"], "stupid": ["stxxupid", "stup1d"], "scum": ["scxxum"], "loser": ["lxosxer"], "trash": ["tr4sh"]}


def test_small_kernels_are_kept():
    marks = list(OBFUSCATED)
    words = [w for some in OBFUSCATED.values() for w in some]
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    brute = lambda x, y: dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))
    got = toxicity.Kernel(marks).values(words)
    assert np.allclose(got, [[brute(subsequences(w), subsequences(m)) for m in marks] for w in words])
    assert all(got[words.index(w), marks.index(m)] > 0 for m, some in OBFUSCATED.items() for w in some)


def test_many_characters_need_little_memory():
    import tracemalloc

    rnd = random.Random(3)
    marks = ["".join(chr(0x4E00 + 16 * i + k) for k in rnd.sample(range(16), 4)) for i in range(125)]
    assert len(set("".join(marks))) == 500
    words = [m[:2] + "x" + m[2:] for m in marks] + ["\u4e00" * 20, "abc"] + ["".join(chr(rnd.randrange(0x4E00, 0x4E00 + 2000)) for _ in range(30)) for _ in range(50)]
    tracemalloc.start()
    kernel = toxicity.Kernel(marks)
    got = kernel.values(words)
    assert tracemalloc.get_traced_memory()[1] < 64e6
    tracemalloc.stop()
    dense, toxicity.DENSE = toxicity.DENSE, 1 << 60
    assert kernel.place is None and np.allclose(got, [[brute_kernel(w, m) for m in marks] for w in words])
    toxicity.DENSE = dense


def test_two_thousand_characters():
    marks = ["".join(chr(0x4E00 + 16 * i + k) for k in range(16)) for i in range(125)]
    assert len(set("".join(marks))) == 2000
    assert np.allclose(toxicity.Kernel(marks).values([marks[7], marks[9] + "a"]).argmax(1), [7, 9])


@pytest.mark.parametrize("first", [ord("a"), 0xE0, 0x4E00, 0x1F600])
def test_long_words_are_read_whole(first):
    """An insult at any place of an unbroken run of other characters, of one to four bytes each."""
    rnd = random.Random(6)
    filler = "".join(chr(first + rnd.randrange(24)) for _ in range(6000))
    mark = "unverschaemterkerl" + "ß" * 4
    model = toxicity.ToxicityModel([mark, "idiot"])
    for at in (0, 1, 15, 16, 17, 31, 32, 200, 5000):
        for word, least in ((mark, 0.5), ("idiot", 0.15)):
            assert model.margins([filler[:at] + word + filler[at:at + 40]])[0] > least, (at, word)
    assert model.margins([chr(0x4E00) * 100_000, "y" * 33]).tolist() == [0, 0]


def test_obfuscated_and_short_insults_score_above_clean(frame):
    plain = "we all went home and saw nothing"
    rows = [(i, f"{plain}\nsuch a {word} he was", 1) for i, word in enumerate([*OBFUSCATED, "oaf"] * 10)] + [(100 + i, f"{plain}\nsuch a day he had", 0) for i in range(60)]
    model = toxicity.train(frame(rows, "doc_id long, text string, y int"))
    assert "oaf" in model.kernel.landmarks
    clean = model.scores([plain])[0]
    for word in ["oaf", *(w for some in OBFUSCATED.values() for w in some)]:
        assert model.scores([f"{plain}\nmy {word}"])[0] > clean, word


def test_toxicity_on_held_out_rows(spark):
    label, score = held_out(spark, toxicity.op6_subsequence_kernel_toxicity, "toxic", "/root/testdata/sf0.1")
    flagged = score >= 0.3
    assert auc(label, score) > 0.9  # about a tenth of the labels go against the words of their texts
    assert label[flagged].mean() > 0.4 and flagged[label == 1].mean() > 0.85


def count_model(text, lang="a"):
    import pandas as pd

    rows = pd.concat(list(language.counted(iter([pd.DataFrame({"lang": [lang], "text": [text]})]))))
    return language.KneserNey(rows["hi"].to_numpy(np.int64).view(np.uint64), rows["lo"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(), 28)


def brute_kneser_ney(text, alphabet):
    """Probability of a character after three others, from dictionaries."""
    clean, grams = "   " + "".join(c if c.isalpha() else " " for c in text.lower()), {}
    clean = "   " + " ".join(clean.split()) + " "
    for i in range(len(clean) - 3):
        grams[clean[i:i + 4]] = grams.get(clean[i:i + 4], 0) + 1
    levels = [grams]
    for _ in range(3):
        lower = {}
        for g in levels[-1]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        levels.append(lower)

    def p(g):
        out = 1 / alphabet
        for order in range(1, 5):
            table, part = levels[4 - order], g[4 - order:]
            ones, twos = sum(v == 1 for v in table.values()), sum(v == 2 for v in table.values())
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            same = {k: v for k, v in table.items() if k[:-1] == part[:-1]}
            if same:
                total = sum(same.values())
                out = max(same.get(part, 0) - d, 0) / total if part in same else 0.0
                out += d * len(same) / total * p_low(part, order)
            else:
                out = p_low(part, order)
        return out

    def p_low(part, order):
        return 1 / alphabet if order == 1 else memo(part[1:])

    def memo(part):
        order = len(part)
        table = levels[4 - order]
        ones, twos = sum(v == 1 for v in table.values()), sum(v == 2 for v in table.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        same = {k: v for k, v in table.items() if k[:-1] == part[:-1]}
        low = 1 / alphabet if order == 1 else memo(part[1:])
        if not same:
            return low
        total = sum(same.values())
        return max(same.get(part, 0) - d, 0) / total + d * len(same) / total * low

    return memo


def test_kneser_ney_equals_brute_force_and_sums_to_one():
    text = "The cat sat on the mat, then the cat ate the rat; that is that."
    model, p = count_model(text), brute_kneser_ney(text, 28)
    code = lambda g: [np.array([ord(c)], np.uint64) for c in g]
    for g in ("the ", " the", "  th", "   t", "cat ", "xyzq", "hat ", "at t", "catx"):
        assert math.isclose(math.exp(model.log_probability(code(g))[0]), p(g), rel_tol=1e-9), g
    letters = "abcdefghijklmnopqrstuvwxyz "
    for context in ("the", " ca", "zzz"):
        total = sum(math.exp(model.log_probability(code(context + c))[0]) for c in letters)
        assert abs(total - 27 / 28 if context == "zzz" else total - 1) < 0.05


def test_language_on_held_out_rows(spark):
    rows = language.op10_kneser_ney_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.98
    assert rows["rejected"].mean() < 0.01


def test_language_edges(frame):
    docs = frame([(1, "the house and the garden", "en", 1), (2, "das Haus und der Garten", "de", 1), (3, None, "de", 1), (4, "123 !!", None, 1), (None, "the cat", "en", 1), (6, "", None, 1), (7, "the " * 50_000, None, 1)], "doc_id long, text string, lang string, score int")
    model = language.train(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[7][0] == "en"
    assert got[3] == got[4] == got[6] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got.values())
    none = frame([], "doc_id long, text string, lang string")
    assert language.train(none) is None and language.predict(none, model).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, None).collect()} == {"und"}


def test_every_sequence_of_a_large_alphabet_is_kept(frame):
    rnd = random.Random(4)
    texts = ["".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(15_000)) for _ in range(20)]
    model = language.train(frame([(i, t, "zh") for i, t in enumerate(texts)], "doc_id long, text string, lang string"))
    whole = language.KneserNey(*count_rows(texts), model.models[0].alphabet)
    assert len(whole.orders[0][0]) > 1 << 18  # nearly all of count one
    seen = [np.array([ord(c)], np.uint64) for c in texts[3][100:104]]
    assert math.isclose(model.models[0].log_probability(seen)[0], whole.log_probability(seen)[0], rel_tol=1e-9)


def count_rows(texts):
    import pandas as pd

    rows = pd.concat(list(language.counted(iter([pd.DataFrame({"lang": ["a"] * len(texts), "text": texts})])))).groupby(["hi", "lo"], as_index=False)["n"].sum()
    return rows["hi"].to_numpy(np.int64).view(np.uint64), rows["lo"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy()


def test_joined_models_give_the_same_languages(spark, frame, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("doc_id % 5 = 0")
    docs = docs.unionByName(frame([(-1, "x" * 9, "rare"), (-2, None, "de"), (-3, "12", None), (None, "the house", "en"), (-4, "", "de"), (-5, "\u4e00\u4e01 new letters", None), (2**60 + 1, "the end", None)], "doc_id long, text string, lang string"))
    held = language.train(docs)
    one = {r["doc_id"]: r for r in language.predict(docs, held).collect()}
    monkeypatch.setattr(language, "HELD_ROWS", 100)
    monkeypatch.setattr(language, "GROUP_CHARS", 100_000)
    model = language.train(docs)
    assert model.models is None and held.models is not None and model.slope == held.slope and np.allclose(model.limits, held.limits, rtol=1e-5)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert set(got) == set(one) and language.predict(docs, model).count() == docs.count()
    for doc_id, r in got.items():
        assert (r["lang_pred"], r["rejected"]) == (one[doc_id]["lang_pred"], one[doc_id]["rejected"])
        assert math.isclose(r["cross_entropy"], one[doc_id]["cross_entropy"], rel_tol=1e-5) and math.isclose(r["score"], one[doc_id]["score"], abs_tol=1e-4)
    monkeypatch.setattr(language, "training_rows", lambda docs: docs)
    kept = language.keep_known_languages(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in one.items() if not r["rejected"]} and kept.columns == docs.columns


def test_any_number_of_labels(spark, frame):
    """A dirty label column: 1,500 labels of one row each beside two real languages."""
    docs = frame([(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden of the king", "en"), ("das Haus und der Garten von dem Wald", "de")] * 20)]
                 + [(1000 + i, f"q{chr(97 + i % 26)}x z", f"label {i}") for i in range(1500)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.langs) == 1502 and np.isfinite(model.limits).all()
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs.where("doc_id < 1000"), model).collect()}
    assert all(got[i] == ("de" if i % 2 else "en") for i in got)


def test_nothing_labelled_keeps_all(spark, frame):
    docs = frame([(1, "text", None), (2, None, None), (None, "12", None)], "doc_id long, text string, lang string")
    assert language.keep_known_languages(spark, docs, SF).count() == 3


def test_rare_languages_have_limits(frame):
    docs = frame([(i, "the house and the garden", "en") for i in range(5000)] + [(9999, "das Haus und der Garten", "de")], "doc_id long, text string, lang string")
    assert np.isfinite(language.train(docs).limits).all()
