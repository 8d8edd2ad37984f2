import random
import re

from tracelake.llm import quality
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    w = WORD.findall(text)

    def covered(n, first_too):
        grams = {}
        for i in range(len(w) - n + 1):
            grams.setdefault(tuple(w[i:i + n]), []).append(i)
        inside = set()
        for places in grams.values():
            if len(places) > 1:
                for i in places if first_too else places[1:]:
                    inside |= set(range(i, i + n))
        return inside

    seen, dup, chars = set(), 0, 0
    for line in text.split("\n"):
        if not WORD.search(line):
            continue
        if line in seen:
            dup, chars = dup + 1, chars + sum(map(len, WORD.findall(line)))
        seen.add(line)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
           "n_repeat_words": len(covered(3, True)), "dup_line_chars": chars}
    for n in quality.LIMITS:
        out[f"dup_{n}gram_chars"] = sum(len(w[i]) for i in covered(n, False))
    return out


def verdict(m):
    failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
    kept = not failed and 100 * m["dup_line_chars"] <= 20 * m["word_chars"] and all(
        100 * m[f"dup_{n}gram_chars"] <= limit * m["word_chars"] for n, limit in quality.LIMITS.items())
    return failed, kept


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice(["a", "bé", "中c", "d#", "ee", "<f>"]) for _ in range(rng.randrange(80))]
        out.append("".join(w + rng.choice([" ", "\n", "\t ", " "]) for w in words) + " ".join(words[:rng.randrange(40)]))
    return out


def test_counts_equal_brute_force():
    cases = texts(1, 200) + ["", " ", "\n\n", "x", "a\na\na", "a \na\na ", "a b c a b c a b c", "x y z w"]
    got = quality.measure([t.encode() for t in cases])
    for i, t in enumerate(cases):
        assert {k: int(v[i]) for k, v in got.items()} == by_hand(t), repr(t)


def test_texts_of_a_slice_do_not_mix():
    got = quality.measure([b"a b c d e f g", b"a b c d e f g"])
    assert got["n_repeat_words"].tolist() == [0, 0]


def test_awkward_documents(awkward, empty):
    rows = quality.judge(awkward).collect()
    assert len(rows) == len(AWKWARD)
    want = sorted((str(a[0]), *by_hand(a[1]).values(), *verdict(by_hand(a[1]))) for a in AWKWARD)
    fields = list(by_hand(""))
    assert sorted((str(r["doc_id"]), *[r[f] for f in fields], r["base_failed"], r["kept"]) for r in rows) == want
    assert quality.judge(empty).count() == 0


def test_verdict_on_repetition(spark):
    rng = random.Random(3)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    stuck = clean + " " + " ".join(clean.split()[:120])
    docs = spark.createDataFrame([(1, clean), (2, stuck), (3, "too short")], "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judge(docs).collect()}
    # The second repeats 120 of 420 words: two thirds of its words are in repeated windows.
    assert got[1] == (False, True) and got[2][1] is False and got[3] == (True, False)
