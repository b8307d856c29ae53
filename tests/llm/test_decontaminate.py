import random
from itertools import combinations

from crewspark.llm import decontaminate as dc


def words(text):
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower()).split()


def brute(docs, items, window=13, share=0.8):
    """Every pair and every shift; hits of the seeds are checked word by word."""
    first = {}
    for i, t in sorted(items):
        if words(t):
            first.setdefault(tuple(words(t)), i)
    out = set()
    for d, t in docs:
        doc = words(t)
        for item, i in first.items():
            n = len(item)
            masks = dc.masks_of(n, dc.MASKS)
            for shift in range(-n, len(doc)):
                hit = any(all(doc[shift + at + k] == item[at + k] for k, b in enumerate(m) if b == "1")
                          for m in masks for at in range(n - len(m) + 1) if shift + at >= 0 and shift + at + len(m) <= len(doc))
                if hit:
                    a, b = max(0, -shift), min(n, len(doc) - shift)
                    same, w = [item[k] == doc[shift + k] for k in range(a, b)], min(window, n)
                    if any(sum(same[k:k + w]) >= share * w for k in range(len(same) - w + 1)):
                        out.add((d, i))
    return out


def test_pairs_equal_brute_force(frame):
    rnd = random.Random(8)
    word = lambda: rnd.choice(["the", "of", "and", "to", "in"]) if rnd.random() < 0.3 else "w" + str(rnd.randrange(300))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([30, 45, 20, 12, 10, 9, 7, 6, 5, 3, 1, 60])]
    items += [(20, items[0][1].upper()), (21, ""), (22, None), (23, "!!"), (None, "x y z w v u t")]
    docs = []
    for i in range(60):
        t = [word() for _ in range(rnd.randrange(5, 60))]
        if i % 2:
            p = items[i % 12][1].split()
            if i % 4 == 1 and len(p) > 20:
                p = p[3:20]
            for _ in range(i % 5):
                p[rnd.randrange(len(p))] = word()
            t[3:3] = p
        docs.append((i, (", " if i % 3 else " ").join(t)))
    docs += [(100, items[8][1]), (101, items[10][1] + "."), (102, None), (103, ""), (104, "filler " * 30_000 + items[1][1])]
    got, classes = dc.contaminated_pairs(frame([(*d, 1, 2) for d in docs], "doc_id long, text string, item_id int, seed int"), frame(items, "item_id long, text string"))
    want = brute(docs, [i for i in items if i[0] is not None])
    assert len(want) > 15
    assert {tuple(r) for r in got.collect()} == want
    assert {r["class_id"] for r in classes.where("item_id = 20").collect()} == {0}


def test_flags_and_empty_tables(frame):
    docs, items = "doc_id long, text string", "item_id long, text string"
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    got = {r["doc_id"]: (r["n_items"], r["item_ids"], r["contaminated"]) for r in dc.flagged(frame([(1, "see " + text), (1, "see " + text), (2, "clean"), (None, text)], docs), frame([(7, text)], items)).collect()}
    assert got == {1: (1, [7], True), 2: (0, [], False)}
    assert dc.flagged(frame([], docs), frame([(7, text)], items)).count() == 0
    assert [r["contaminated"] for r in dc.flagged(frame([(1, text)], docs), frame([], items)).collect()] == [False]


def accepted(doc, item, window=13, share=0.8):
    """Whether any shift passes the verifier, without seeds."""
    n, w = len(item), min(window, len(item))
    for shift in range(-n, len(doc)):
        same = [item[k] == doc[shift + k] for k in range(max(0, -shift), min(n, len(doc) - shift))]
        if any(sum(same[k:k + w]) >= share * w for k in range(len(same) - w + 1)):
            return True
    return False


def test_every_accepted_placement_of_a_short_item_is_found(frame):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (*range(1, 14), 15)}
    docs = []
    for n, item in items.items():
        for gone in [c for e in range(4) for c in combinations(range(n), e)]:
            docs.append(["so", "it", "reads", *("other" if k in gone else w for k, w in enumerate(item)), "and", "ends"])
    want = {(d, n) for d, doc in enumerate(docs) for n, item in items.items() if f"i{n}w" in " ".join(doc) and accepted(doc, item)}
    assert {n for _, n in want} == set(items)
    got, _ = dc.contaminated_pairs(frame([(d, " ".join(t)) for d, t in enumerate(docs)], "doc_id long, text string"), frame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == want
