import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from crewspark.llm import fingerprints as P

SCHEMA = "doc_id long, text string, fingerprint string, bucket string, copy int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def phrases(line):
    """Phrases by walking over the words."""
    tokens = re.findall(r"[ \t]+|[^ \t.!?]{1,64}|[.!?]+", line)
    out, words = [], 0
    now = ""
    for i, t in enumerate(tokens):
        blank, mark = t[0] in " \t", t[0] in ".!?"
        if blank:
            now += t
            continue
        after = i and tokens[i - 1][0] in " \t"  # a blank before this token
        if now.strip(" \t"):
            ended = now.rstrip(" \t")[-1] in ".!?"
            if ended and (not mark or after) or not mark and (words == 3 or not after) or mark and after and not ended and words == 3:
                out.append(now)
                now, words = "", 0
        now += t
        words += not mark
    return out + [now] if now else out


def fingerprint(text):
    paragraphs = []
    for line in (text or "").split("\n"):
        ds = [h(p) for p in phrases(line)]
        paragraphs.append((h("".join(ds)), ds))
    runs = [[]]
    for i, (d, ds) in enumerate(paragraphs):
        runs[-1].append((d, ds))
        if d[0] < "4" and i + 1 < len(paragraphs):
            runs.append([])
    sections = [(h("".join(d for d, _ in run)), ",".join(d[:8] + "".join("." + x[:6] for x in ds) for d, ds in run)) for run in runs]
    return h("".join(d for d, _ in sections)) + "/" + "/".join(d[:16] + ":" + shown for d, shown in sections)


def near(a, b):
    if a[:64] == b[:64]:
        return 1.0
    one, two = (set(re.findall(r"\.([0-9a-f]+)", x)) for x in (a, b))
    return 2 * len(one & two) / (len(one) + len(two)) if one or two else 0.0


WORDS = ["the", "a", "word.", "Éa!", "x" * 70, "3.14", "?!", "end.\n", "\n", "\n\n", "\t tab", "日本語日本語", "\U0001F600"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    return ["", " ", "\n", "...", "one", "x" * 300, "long words. " * 20_000, *(" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 60))) for _ in range(300))]


def test_phrases_are_the_whole_line(spark, frame, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", F.transform(F.split("text", "\n"), lambda x: F.array_join(F.regexp_extract_all(x, F.lit(P.PHRASE), F.lit(0)), "")).alias("back"))
    for r in rows.collect():
        assert "\n".join(r["back"]) == texts[r["i"]]


def test_fingerprints_equal_a_walk_over_the_words(spark, texts):
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", P.fingerprint(F.col("text")).alias("f")).collect()
    for r in got:
        assert r["f"] == fingerprint(texts[r["i"]]), texts[r["i"]][:200]


@pytest.mark.parametrize("buckets", [1, 3, 200])
def test_rows_equal_brute_force(spark, frame, texts, buckets):
    rows = [(i * 7 - 300, t) for i, t in enumerate(texts)] + [(5000, None), (5001, "twice b"), (5001, "twice a"), (5001, "twice a"), (6000, texts[-1])]
    alone = [(None, "No id here, but words."), (None, None)]
    got = P.fingerprints(spark, frame([(*r, "f", "b", 1) for r in rows + alone], SCHEMA, 6), buckets).collect()
    rows.sort(key=lambda r: (r[0], r[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        want.append((doc_id, text or "", rows[(i + 1) % len(rows)][1] or ""))
    want += [(None, t or "", t or "") for _, t in alone]
    assert len(got) == len(want)
    expected = []
    for doc_id, text, after in want:
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(after)
        expected.append((doc_id, len(text), h(edited), a, b, near(a, b), near(a, c)))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(expected, key=str)


def test_first_difference(spark):
    line = "one two three four five six seven. And more words here."
    text = "\n".join(f"{i} {line}" for i in range(40))
    cases = {"same": text, "none": "", "word": text.replace("23 one two", "23 one twO"), "longer": text + " x", "cut": text[:400]}
    rows = spark.createDataFrame([(k, text, v) for k, v in cases.items()], "k string, a string, b string").select("k", P.fingerprint(F.col("a")).alias("a"), P.fingerprint(F.col("b")).alias("b"))
    got = {r["k"]: r for r in rows.select("k", "a", "b", P.first_difference("a", "b").alias("d"), P.likeness("a", "b").alias("near")).collect()}
    assert got["same"]["d"] is None and got["same"]["near"] == 1.0 and got["none"]["near"] == 0.0
    trees = {k: [[p.split(".")[1:] for p in s.split(":")[1].split(",")] for s in r["b"].split("/")[1:]] for k, r in got.items()}
    one = [[p.split(".")[1:] for p in s.split(":")[1].split(",")] for s in got["same"]["a"].split("/")[1:]]
    s, p, q = got["word"]["d"]
    assert one[:s] == trees["word"][:s] and one[s][:p] == trees["word"][s][:p] and one[s][p][:q] == trees["word"][s][p][:q] and one[s][p][q] != trees["word"][s][p][q]
    assert sum(len(x) for x in one[:s]) + p == 23
    assert 0.9 < got["word"]["near"] < 1.0
    assert got["none"]["d"]["section"] == 0 and got["longer"]["d"]["phrase"] == len(one[-1][-1]) - 1


def test_native_only_one_shuffle_of_the_texts(spark, frame):
    docs = frame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    df = P.fingerprints(spark, docs, 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
    assert plan.count("hashpartitioning(bucket") == 1
    assert P.fingerprints(spark, frame([], "doc_id long, text string")).count() == 0
