"""Personal data, periodic runs and hard negatives against brute force, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives, periods, pii
from tidemark.llm import queries as Q

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")
DOC = "doc_id long, text string, start long, spans string, n_email int, __row int"


def odd_docs(spark):
    long = " ".join(f"w{k % 977}" for k in range(60_000)) + " a@b.example.com"
    data = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (6, "a b " * 9), (6, "a b " * 9), (None, "x x x x x x x x x x x x x"), (None, None), (7, "Ünï \U0001f600 me@home.org")]
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in data], DOC)


# op11

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(x) for x in re.sub("[^0-9]", "", m[0])]
            luhn = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_plain_spans_match_the_patterns():
    r = random.Random(3)
    for _ in range(20_000):
        text = "".join(r.choice(letters) for letters in [r.choice(["a@.-1", "a@.", "0123456789 -+().", "1.2 ", "12.5@a-+ "])] for _ in range(r.randint(0, 60)))
        assert pii.plain(text) == brute_spans(text), text


DISGUISED = [
    ("write john [at] example [dot] com now", "email", "john [at] example [dot] com"), ("john(at)example.org", "email", "john(at)example.org"), ("ask jane dot doe at example dot com please", "email", "jane dot doe at example dot com"),
    ("j.d at example dot co dot uk", "email", "j.d at example dot co dot uk"), ("an john @ example . com.", "email", "john @ example . com"), ("von jоhn@exаmple.com an", "email", "jоhn@exаmple.com"), ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("jo​hn@exam​ple.com", "email", "jo​hn@exam​ple.com"), ("x a&#64;b.com y", "email", "a&#64;b.com"), ("ana arroba ejemplo punto es", "email", "ana arroba ejemplo punto es"),
    ("call plus four nine one seven two three four five six seven", "phone", "plus four nine one seven two three four five six seven"), ("tel. +49 (0) 171 five five five 12 34", "phone", "+49 (0) 171 five five five 12 34"),
    ("no four one one one one one one one one one one one one one one one ok", "card", "four one one one one one one one one one one one one one one one"), ("4111 1111 1111 111l", "card", "4111 1111 1111 111l"), ("٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("at one nine two dot one six eight dot one dot one end", "ip", "one nine two dot one six eight dot one dot one"), ("quatre-un-un-un un un un un un un un un un un un un", "card", "quatre-un-un-un un un un un un un un un un un un un"),
]


@pytest.mark.parametrize(("text", "kind", "source"), DISGUISED)
def test_disguised_spans_map_back(text, kind, source):
    base, more = pii.spans(text)
    assert (kind, text.index(source), text.index(source) + len(source)) in more
    assert set(base) == set(brute_spans(text))
    assert pii.masked(text).replace(f"<{kind}>", source, 1) == text


@pytest.mark.parametrize("text", ["look at polka dot dress", "we met at example.com today", "one two three, they said at noon.", "ping @ home. The end", "a (at) b", "Punkt zwei drei vier", "room 4l and 5O", "zero at dot com"])
def test_prose_is_left_alone(text):
    assert pii.spans(text)[1] == [], pii.spans(text)


def test_personal_data_of_all_documents(spark):
    got = {r["doc_id"]: r for r in Q.op11_personal_data(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    for r in rows:
        base, out = brute_spans(r["text"]), got[r["doc_id"]]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [out[f"n_{k}"] for k in PATTERNS] == [sum(k == x[0] for x in base) for k in PATTERNS]
        assert out["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(out["spans"].split(","))


def test_personal_data_of_odd_rows(spark):
    got = pii.find(odd_docs(spark)).collect()
    assert len(got) == 10 and sum(r["n_email"] for r in got) == 3
    assert {r["spans"] for r in got if r["doc_id"] in (1, 2, 3)} == {""}
    assert pii.find(odd_docs(spark).limit(0)).collect() == []
    masked = pii.mask(odd_docs(spark))
    assert masked.columns == odd_docs(spark).columns and masked.filter("text like '%<email>%'").count() == 3


def test_personal_data_in_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "(at" * 100_000, "a at " * 60_000, "1.1." * 80_000, "+1 " * 100_000, "a@" * 150_000, " " * 300_000, "l1 " * 100_000, "a at b dot " * 30_000):
        assert pii.spans(text) is not None


# op12


def brute_runs(w):
    """(start, end) -> smallest period, by comparing all words at all distances."""
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s >= p:
                out.setdefault((s, i + p), p)
            i += 1
    return out


def sequences(r, k):
    n, few = r.randint(0, 300), lambda n, letters="ab": [r.choice(letters) for _ in range(n)]
    if k == 0:
        return few(n)
    if k == 1:  # Fibonacci word
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if k == 2:  # regions of one small period that touch
        u = few(r.randint(2, 9), "aab")
        x, y = (u * 50)[: r.randint(1, 120)], (u * 50)[: r.randint(1, 120)]
        return few(3) + x + y + x + y + few(3)
    if k == 3:
        u = few(r.randint(2, 6), "aab")
        x = (u * 50)[: r.randint(10, 90)]
        return (u * 9)[: r.randint(0, 5)] + x + x + (u * 9)[r.randint(0, 5) :][: r.randint(0, 20)]
    if k == 4:
        return [bin(i).count("1") % 2 for i in range(n)]
    s = few(3)
    while len(s) < n:
        s += s[-r.randint(1, len(s)) :] * r.randint(1, 3) + few(r.randint(0, 1), "abc")
    return s[:n]


def test_runs_match_brute_force():
    r = random.Random(5)
    for k in range(500):
        w = sequences(r, k % 6)
        number = {x: n for n, x in enumerate(dict.fromkeys(w))}
        codes = np.array([number[x] for x in w], np.int64)
        assert (periods.find(codes, len(codes)) if w else {}) == brute_runs(w), w


def test_runs_of_all_documents(spark):
    got = {r["doc_id"]: r for r in Q.op12_periodic_runs(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    found = 0
    for r in rows:
        w, h = WORDS.findall(r["text"] or ""), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) > 1500:  # too slow for brute force
            continue
        runs = sorted((s, e - s, q) for (s, e), q in brute_runs(w).items() if e - s >= max(12, 2 * q))
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        out = got[r["doc_id"]]
        assert (out["n_runs"], out["start"], out["length"], out["period"]) == (len(runs), *best)
        assert out["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert out["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert out["collapsed_sha256"] == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest()
        found += len(runs)
    assert found > 10


def test_runs_of_odd_rows(spark):
    got = collections.defaultdict(list)
    for r in periods.find_runs(odd_docs(spark), collapsed=True).collect():
        got[r["doc_id"]].append(r)
    assert [(x[0]["n_runs"], x[0]["start"], x[0]["collapsed_text"]) for x in (got[1], got[2], got[3])] == [(0, None, "")] * 3
    assert [(x["n_runs"], x["length"], x["period"], x["exponent_milli"], x["collapsed_text"]) for x in got[6]] == [(1, 18, 2, 9000, "a b")] * 2
    assert sorted(x["n_runs"] for x in got[None]) == [0, 1]
    assert got[4][0]["period"] == 977 and [tuple(x) for x in got[4][0]["runs"]] == [(0, 60_000, 977)]
    assert periods.find_runs(odd_docs(spark).limit(0)).collect() == []


# op13


def brute_negatives(rows):
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for a, (i, q, label) in enumerate(kept):
        if i is None or i % 50:
            continue
        score = [sum(x * y for x, y in zip(q, r[1], strict=False)) for r in kept]
        order = sorted(range(len(kept)), key=lambda j: (-score[j], math.inf if kept[j][0] is None else kept[j][0]))
        for p in [j for j in order if j != a and kept[j][2] == label][:5]:
            some = [j for j in order if kept[j][2] != label and 50 * score[p] <= 100 * score[j] <= 95 * score[p]][:3]
            out += [(i, kept[p][0], k + 1, kept[j][0], score[p], score[j]) for k, j in enumerate(some)]
    return sorted(out, key=repr)


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in negatives.mine(df, F.col("vec_id") % 50 == 0, label=label).collect()), key=repr)


def test_negatives_match_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert mined(df) == brute_negatives([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


def test_negatives_of_odd_rows(spark):
    """Nulls, NaN, infinity, zero and short vectors, ties, copies, null and repeated ids, clashing columns, large numbers."""
    r = random.Random(1)
    near = lambda c: [x + r.gauss(0, 0.2) for x in c]
    heads = [[r.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    data = [(k, near(heads[k % 3]), r.randint(0, 3)) for k in range(260)]
    data += [(300, None, 1), (301, [1.0, None], 1), (350, [math.nan] * 6, 1), (351, [math.inf] * 6, 2), (352, [1.0] * 6, None), (400, [0.0] * 6, 1), (None, near(heads[0]), 1), (None, near(heads[0]), 2), (450, [1.0, 2.0], 2), (500, near(heads[1]), 0), (501, [3e6] * 6, 1), (550, [2e6] * 6, 1)]
    data += [(500, data[-3][1], 0), (503, data[-3][1], 1), (600, [], 1)] + [(700 + k, heads[0], 1 + k % 2) for k in range(80)]
    df = spark.createDataFrame([(*x, 1, 2.0) for x in data], "vec_id long, embedding array<double>, label int, uid int, score double")
    assert mined(df) == brute_negatives(data)
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id = 300")) == []


def test_negatives_walk_in_parts(spark, monkeypatch):
    """Lists, members and blocks in many parts, and stops before the end of the lists."""
    for name, value in (("SPAN", 40), ("GROUP", 3), ("BLOCK", 7)):
        monkeypatch.setattr(negatives, name, value)
    r = random.Random(2)
    data = [(k, [r.gauss(0, 1) / (1 + k % 9) for _ in range(3)], r.randint(0, 2)) for k in range(600)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert mined(df) == brute_negatives(data)
