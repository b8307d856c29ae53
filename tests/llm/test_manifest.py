import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from crewspark.llm import manifest as M

SCHEMA = "doc_id long, text string, source string, lang string, n_chars int, digest string, key string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        out.append(("".join(run[:at % 8]), "".join(run[at % 8 + 1:])))
        at //= 8
    return out


def brute_force(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, text, source, lang, n_chars)."""
    def leaf(doc_id, text, source, lang, n_chars):
        return h("".join(map(field, (doc_id, source, lang, n_chars, text))))

    def lowered(doc_id, text):
        if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 3:
            return text
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(*r), leaf(r[0], lowered(r[0], r[1]), *r[2:]), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([x[2] for x in sorted(groups[g])]) for g in order}
    upper = levels_of([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for at, (_, _, digest, claimed, doc_id) in enumerate(sorted(groups[g])):
            path = siblings(trees[g], at) + siblings(upper, place)
            node = claimed
            for left, right in path:
                node = h(left + node + right)
            out.append((doc_id, digest, trees[g][-1][0], upper[-1][0], h("".join(a + b for a, b in path)), node, node == upper[-1][0]))
    return sorted(out, key=str)


def manifested(df):
    tampered = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False)), F.translate("text", M.CAPITALS, M.SMALL)).otherwise(F.col("text"))
    got = M.manifest(df, F.col("lang"), "doc_id", M.document_leaf(F.col("text")), M.document_leaf(tampered))
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("n", [1, 8, 9, 600])
def test_rows_equal_brute_force(frame, n):
    rnd = random.Random(n)
    langs = [None, "", "-", "en", "é", "z", "Z", "\U0001F600", *(f"l{i}" for i in range(12))] if n > 9 else ["en"]
    rows = [(i * 3 - 50, rnd.choice(["Some Text", "ÄB c", "", None, "nothing to lower"]), rnd.choice(["a", None]), rnd.choice(langs) if i % 3 else langs[-1], rnd.choice([3, None])) for i in range(n)]
    if n > 9:
        rows += [(None, "No Id", None, "en", 1), (None, "No Id", None, "en", 1), (7, "Twice", "x", "en", 2), (7, "Twice", "x", "en", 2), (7, "other Text", "x", "en", 2), (10**15, "Far " * 50_000, "x", None, None)]
    assert manifested(frame([(*r, "d", "k") for r in rows], SCHEMA, 5)) == brute_force(rows)


def test_no_rows(frame):
    assert manifested(frame([], SCHEMA)) == []


def test_values_do_not_run_together(frame):
    rows = [(1, "b", "a", "en", 1), (1, "", "ab", "en", 1), (1, None, "-", "en", 1), (1, "-", None, "en", 1)]
    assert len({r[1] for r in manifested(frame([(*r, "d", "k") for r in rows], SCHEMA))}) == 4
