"""Each operator against brute force, exact round trips or held-out accuracy, and on odd rows."""

import collections
import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bloom, common, decontam, html, langid, lines, mixing, quality, repeats, simhash, tokens, urls
from tidemark.llm import queries as Q
from tidemark.llm.minhash import band_keys

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, __row int, n_words string"


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


def odd_docs(spark):
    """Nulls, empty, blank and very long texts, repeated rows, ties, and extra columns with clashing names."""
    long = prose(30_000, 1)
    data = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, long, "en", "b"), (5, long, "en", "b"), (6, prose(80, 2), "en", "a"), (6, prose(80, 2), "en", "a"), (7, prose(60, 3) + "\nx\nx", "en", None), (None, prose(70, 4), None, "a"), (None, None, None, None), (8, "one two", "fr", "c"), (9, "Ünïcödé \U0001f600 <|endoftext|>  a  b", "fr", "c")]
    return spark.createDataFrame([(*r, None, 1, "x", 2, "y") for r in data], DOC)


def empty_docs(spark):
    return spark.createDataFrame([], DOC)


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


# op1


def levels(sizes):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    left = float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in full]
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            full.add(s)


def test_mix(spark):
    d = docs(spark).withColumn("source", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.col("source")))
    out = mixing.mix(d).join(d.select("doc_id", "source", "text"), "doc_id").collect()
    sizes = collections.Counter()
    for r in out:
        assert r["size"] == len(WORDS.findall(r["text"] or ""))
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] += r["size"]
    want, taken = levels(sizes), collections.Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.05, abs=60)
    again = {(r["doc_id"], r["copies"]) for r in mixing.mix(d.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in out}


def test_mix_rates_are_exponential_in_size(spark):
    for source in mixing.mix(docs(spark)).groupBy("source_size").agg(F.collect_list(F.struct("size", "rate")).alias("x")).collect():
        points = [(x["size"], np.log(x["rate"])) for x in source["x"] if x["size"] and x["rate"] < 2.999]
        slopes = [b / a for a, b in points]
        assert np.ptp(slopes) < 1e-9 if slopes else True


def test_resample_repeats_rows(spark):
    d = docs(spark)
    got = {r["doc_id"]: r["count"] for r in mixing.resample(d).groupBy("doc_id").count().collect()}
    assert got == {r["doc_id"]: r["copies"] for r in mixing.mix(d).collect() if r["copies"]}
    assert mixing.resample(d).columns == d.columns


@pytest.mark.parametrize("ids", [[None], [1, 2, 3]])
def test_resample_does_not_depend_on_the_layout(spark, ids):
    """Texts of one size under null or repeated ids."""
    data = [(ids[k % len(ids)], f"w{k} x y", "abc"[k // 20]) for k in range(60)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    one, three = (sorted((r["text"] for r in mixing.resample(frame.repartition(n, "text")).collect())) for n in (1, 3))
    assert one == three and len(set(one)) > 20


def test_mix_odd(spark):
    out = mixing.mix(odd_docs(spark)).collect()
    assert len(out) == 12 and all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert mixing.mix(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0)] * 2


def test_large_cells_keep_their_copies(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source")).union(spark.range(3000, 3100).select("id", F.lit("a b c"), F.lit("t")))
    taken = {r["source"]: r["t"] for r in mixing.mix(d).join(d, "doc_id").groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert taken["t"] == 900 and abs(taken["s"] - 5400) <= 30


# op2


def brute_lines(rows):
    first, occ = {}, []
    for i, t in rows:
        for k, x in enumerate((t or "").split("\n") if t is not None else []):
            if WORDS.search(x):
                occ.append((i, k, x))
                first.setdefault(x, (i, k))
    sets = {x: {x[j : j + 8] for j in range(max(1, len(x) - 7))} for x in first}
    parent = {x: x for x in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names, inside = sorted(sets, key=first.get), collections.defaultdict(list)
    for x in names:
        for y, n in collections.Counter(y for s in sets[x] for y in inside[s]).items():
            if 10 * n >= 8 * (len(sets[x]) + len(sets[y]) - n):
                a, b = sorted((find(x), find(y)), key=first.get)
                parent[b] = a
        for s in sets[x]:
            inside[s].append(x)
    out = collections.defaultdict(list)
    for i, k, x in occ:
        if first[find(x)] != (i, k):
            out[i].append(k)
    return out


def test_line_dedup(spark, texts):
    want = brute_lines(texts)
    out = lines.dedup_lines(docs(spark)).collect()
    assert sum(want[r["doc_id"]] != r["removed"] for r in out) <= 0.01 * len(out)
    wanted = {(i, k) for i, ks in want.items() for k in ks}
    got = {(r["doc_id"], k) for r in out for k in r["removed"]}
    assert len(wanted & got) >= 0.99 * len(wanted) and len(got - wanted) <= 0.01 * len(got)
    for r in out:
        parts = (dict(texts)[r["doc_id"]]).split("\n")
        assert r["kept_text"] == "\n".join(x for k, x in enumerate(parts) if k not in r["removed"])


def test_line_buckets_of_refused_lines(spark):
    """One passage in many lines that are not similar to each other but in pairs: tiles must find the pairs."""
    shared, rows = prose(40, 9), []
    for k in range(40):
        own = prose(30, 100 + k // 2)
        rows.append((k, shared[:150] + own + ("!" if k % 2 else "")))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in lines.dedup_lines(d).collect()}
    assert got == {k: [0] if k % 2 else [] for k in range(40)} == {k: brute_lines(rows)[k] for k in range(40)}


def test_tile_links_span_components():
    group = [(k, k, prose(20, 5) + "abc"[k % 3]) for k in range(9)]
    left, right = group[:4], group[4:]
    assert len(lines.tile_links(left, right)) == 8


def varied(r, s):
    return "".join(r.choice("xyz") if r.random() < 0.004 else c for c in s)[r.randrange(3) :]


def test_similar_pairs_by_brute_force(monkeypatch):
    """Verdicts of pairs, each line hashed once, however few values are compared at once."""
    r = random.Random(8)
    base = [prose(n, n) for n in (1, 2, 9, 60, 400)] + ["a", "abcdefg", "abcdefgh"]
    some = [varied(r, r.choice(base)) for _ in range(60)]
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(800)]
    sets = [{x[j : j + 8] for j in range(max(1, len(x) - 7))} for x in some]
    want = [10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) for a, b in pairs]
    assert 50 < sum(want) < 750
    for values in (1, 3000, 1 << 15):
        monkeypatch.setattr(lines, "VALUES", values)
        assert lines.similar_pairs(some, *np.array(pairs).T).tolist() == want
    assert lines.similar([some[a] for a, _ in pairs], [some[b] for _, b in pairs]).tolist() == want


def test_small_tiles_go_together(monkeypatch):
    """Many small tiles take few comparisons, large ones stay alone, and all give the links that each tile would."""
    r, tiles, n, asked = random.Random(4), [], 0, []
    for k in range(120):
        base = [prose(15, 3 * k + x) for x in range(2)]
        sides = []
        for count in (r.choice([1, 2, 5]), r.choice([1, 3, 9])) if k else (70, 80):
            sides.append([(n + x, n + x, varied(r, r.choice(base))) for x in range(count)])
            n += count
        tiles.append(tuple(sides))

    def joined(links):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return {x: find(x) for x in list(root)}

    want = joined([x for left, right in tiles for x in lines.tile_links(left, right)])
    alone, pairs = lines.tile_links, lines.similar_pairs
    monkeypatch.setattr(lines, "tile_links", lambda *sides: asked.append("alone") or alone(*sides))
    monkeypatch.setattr(lines, "similar_pairs", lambda *given: asked.append("together") or pairs(*given))
    assert joined(lines.links_of_tiles(tiles)) == want and len(want) > 300
    assert asked.count("alone") == 1 and 1 <= asked.count("together") <= 6


def test_texts_of_wanted_lines(spark):
    """Lines by place, of repeated rows and rows without id too; documents without such a line are not split."""
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (1, "d\ne"), (None, "f\n\ng"), (None, "f\n\ng"), (2, "h"), (3, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    at = lines.exploded(d, "text", "doc_id").dropDuplicates().withColumn("id", F.monotonically_increasing_id())
    wanted = at.filter("line in ('a', 'c', 'e', 'g')").select("id", F.struct("doc_id", "mark", "line_no").alias("place"))
    want = {x["id"]: x["line"] for x in common.cut(at.join(wanted, "id"), "want").collect()}
    got = lines.texts_of(d, wanted, "text", "doc_id").collect()
    assert sorted(x["line"] for x in got) == sorted(want.values()) == ["a", "c", "e", "g"]
    assert {x["id"]: x["line"] for x in got} == want


def test_blank_lines_have_no_visible_character(spark):
    blank = ["", " ", "\t\x0b\x0c\r ", "\u00a0", " x ", "\x00", "\u2028", "\x1c", None]
    d = spark.createDataFrame([(k, x) for k, x in enumerate(blank)], "doc_id long, text string")
    assert sorted(x["doc_id"] for x in lines.exploded(d, "text", "doc_id").collect()) == [k for k, x in enumerate(blank) if x is not None and WORDS.search(x)] == [3, 4, 5, 6, 7]


def test_rejoined_components(spark, monkeypatch):
    """Later links join whole components, along chains too; only the met components are nodes of that."""
    r = random.Random(5)
    known = {n: n - n % 5 for n in range(400)}
    links = [(a, b) for a, b in ((r.randrange(300), r.randrange(300)) for _ in range(45)) if a - a % 5 != b - b % 5]
    want = dict(known)
    for _ in links:
        for a, b in links:
            low, high = sorted((want[a], want[b]))
            want = {n: low if c == high else c for n, c in want.items()}
    asked = []
    monkeypatch.setattr(lines, "components", lambda nodes, edges, name: asked.append(nodes.count()) or common.components(nodes, edges, name))
    got = lines.rejoined(common.cut(spark.createDataFrame(list(known.items()), "node long, component long"), "t"), spark.createDataFrame(links, "a long, b long"))
    assert {x["node"]: x["component"] for x in got.collect()} == want and got.count() == 400
    assert asked == [len({known[x] for link in links for x in link})]


def test_line_odd(spark):
    out = lines.dedup_lines(odd_docs(spark)).collect()
    assert len(out) == 12
    by = {(r["doc_id"], r["n_lines"]): r["removed"] for r in out}
    assert by[1, 0] == [] and by[5, 1] == [0] and by[4, 1] == [] and by[7, 3] == [2] and by[3, 2] == []
    assert lines.dedup_lines(empty_docs(spark)).count() == 0


# op3


def brute_url(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


ODD_URLS = [None, "", "no scheme", "http://", "http://COM/", "http://xcom/", "http://a.b.Example.com/en/x?y#z", "https://www.example.com/en", "https://www.example.com/en/", "x://y.net/fr/://b", "http://net?/es/", "http://ÄB.net/es/#", "http://.net/es/", "http://a..com/\n/q", "http://com"]


@pytest.mark.parametrize("limits", [{}, {"max_bytes": 1}])
def test_urls(spark, limits):
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(ODD_URLS + ODD_URLS[4:6])] + [(None, "http://q.com/", "x", 1)], "page_id long, url string, host string, h int")
    rules = spark.createDataFrame(urls.RULES + [("example.com", "", "block")], "host string, path string, verdict string")
    got = sorted((tuple(r) for r in urls.judge(pages, rules, **limits).collect()), key=repr)
    want = [(r["page_id"], *brute_url(r["url"], urls.RULES + [("example.com", "", "block")])) for r in pages.collect()]
    assert got == sorted(want, key=repr)
    assert urls.judge(pages.limit(0), rules, **limits).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0), **limits).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id")
    levels_ = bloom.build(universe.filter("id % 5 = 0").select("h"), universe.select("h"))
    assert len(levels_) > 2
    got = universe.select("id", F.get(bloom.member(levels_)(F.array("h")), F.lit(0)).alias("in")).filter("in <> (id % 5 = 0)")
    assert got.count() == 0


@pytest.mark.parametrize("max_bytes", [bloom.MAX_BYTES, 10 << 10])
def test_urls_of_long_lists_in_shards(spark, max_bytes):
    """6,000 rules and 80 path lengths: filters larger than max_bytes are asked in shards, with one result."""
    listed = [(f"h{k % 900}.org", "/" + "x" * (k % 80) + str(k), "allow" if k % 3 else "block") for k in range(6000)]
    rules = spark.createDataFrame(listed, "host string, path string, verdict string")
    by_host = {}
    for r in listed:
        by_host.setdefault(r[0], []).append(r)
    asked = [f"http://w{k % 2}.h{k % 1000}.org/" + "x" * (k % 80) + str(k) + "/q"[: k % 3] for k in range(0, 9000, 7)]
    pages = spark.createDataFrame(list(enumerate(asked)), "page_id long, url string")
    want = [(k, *brute_url(u, by_host.get(u.split("/")[2].split(".", 1)[1], []))) for k, u in enumerate(asked)]
    assert sorted(tuple(r) for r in urls.judge(pages, rules, max_bytes=max_bytes).collect()) == want
    assert {w[4] for w in want} == {"allow", "block"}


def test_shards_are_a_partition(spark):
    universe = spark.range(30_000).select(F.xxhash64("id").alias("h"), "id")
    made = list(bloom.shards(universe.filter("id % 2 = 0").select("h"), universe.select("h"), 8 << 10))
    assert len(made) > 2 and sum(1 / of for _, _, of in made) == 1
    assert all(sum(map(len, levels)) <= (8 << 10) + 64 * len(levels) for levels, _, _ in made)
    got = [F.get(bloom.member(*m)(F.array("h")), F.lit(0)).cast("int") for m in made]
    assert universe.filter(sum(got[1:], got[0]) != F.when(F.col("id") % 2 == 0, 1).otherwise(0)).count() == 0


# op4


def brute_repeats(rows, length=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(spark):
    a, b, c = prose(300, 1), prose(200, 2), prose(90, 3)
    rows = [(1, a), (2, b + a[300:900] + c), (3, c + " é " + b[:405]), (4, a[:399]), (5, a[100:500] + "|" + a[100:500]), (6, "ab" * 900), (7, "x" * 401), (8, "x" * 400), (9, c[:100] + a[301:701]), (10, None), (10, c), (None, ""), (11, prose(60, 5)), (11, prose(60, 5)), (12, a[290:910])]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, mark int")
    assert sorted((tuple(r) for r in repeats.repeated(d).collect()), key=repr) == brute_repeats(rows)


def test_repeats_on_the_given_texts(spark, texts):
    some = texts[:120]
    d = spark.createDataFrame(some, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeats.repeated(d).collect()), key=repr) == brute_repeats(some)


def test_repeats_over_chunks(spark, monkeypatch):
    data = (prose(400, 8) + prose(100, 9) + prose(400, 8)).encode()
    whole = repeats.cells(data)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    parts = repeats.cells(data)
    of = lambda x: [(int(a), int(b)) for c in x for a, b in zip(c[0], c[1], strict=True)]
    covered = [p for a, b in of(parts) for p in range(a, b + 1)]
    assert covered == list(range(len(data) - 399)) == [p for a, b in of(whole) for p in range(a, b + 1)]


def test_cells_do_not_depend_on_chunks(monkeypatch):
    joined = lambda found: [np.concatenate(x).tolist() for x in zip(*found, strict=True)]
    for data in ((prose(400, 8) + prose(100, 9) + prose(400, 8)).encode(), b"a" * 5000, prose(900, 3).encode()):
        monkeypatch.undo()
        whole = joined(repeats.cells(data))
        for chunk in (1, 400, 700, 1999):
            monkeypatch.setattr(repeats, "CHUNK", chunk)
            assert joined(repeats.cells(data)) == whole


def test_repeats_in_texts_of_several_chunks(spark, monkeypatch):
    """A clean text over many chunks loses nothing at their borders, by each step of repeated()."""
    rows = [(1, prose(900, 21)), (2, prose(300, 22) + prose(200, 23) + prose(400, 24)), (3, prose(150, 25) + prose(200, 23))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "CHUNK", 700)
    # workers import the module anew, so the cells are made here
    names = ["doc_id", "mark", "n_bytes", "sha", *repeats.ARRAYS]
    made = []
    for r in repeats.keyed(d, "text", "doc_id").collect():
        data = r["text"].encode()
        made.append((r["doc_id"], r["mark"], len(data), hashlib.sha256(data).hexdigest(), *[np.concatenate(x).tolist() for x in zip(*repeats.cells(data), strict=True)]))
    schema = "doc_id long, mark long, n_bytes long, sha string, " + ", ".join(f"{c} array<long>" for c in repeats.ARRAYS)
    monkeypatch.setattr(repeats, "sampled", lambda *_: spark.createDataFrame(made, schema).select(*names))
    got = sorted(tuple(r) for r in repeats.repeated(d).collect())
    assert got == brute_repeats(rows)
    assert got[0][2] == 0 and got[1][2] > 0


def test_repeats_empty(spark):
    assert repeats.repeated(empty_docs(spark)).count() == 0


# op5


def test_tokens(spark, texts):
    from tokenizers import Tokenizer

    path = Q.tokenizer()
    odd = odd_docs(spark).select("doc_id", "text")
    for d in (docs(spark).select("doc_id", "text"), odd):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in d.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want, at = [], 0
        for (i, _), e in zip(rows, Tokenizer.from_file(path).encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
            ids = np.array([*e.ids, 0], "<u4")
            want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        got = tokens.token_output(d, path).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
        assert [tuple(r) for r in got] == want
    assert tokens.token_output(empty_docs(spark), path).count() == 0


@pytest.mark.parametrize("base", [50_257, 65_536, 100_000])
@pytest.mark.parametrize("seed", range(4))
def test_re_pair_round_trip(seed, base):
    r = np.random.default_rng(seed)
    ids = r.integers(0, 5 if seed % 2 else 50, 60_000).astype(tokens.symbol_type(base)) + (base - 50)
    last = r.random(len(ids)) < 0.01
    last[-1] = True
    n_docs = np.diff(np.concatenate(([0], np.flatnonzero(last) + 1)))
    sym, ends, rules, lens = tokens.re_pair(ids.copy(), last.copy(), base)
    table = tokens.expansions(rules, lens, base)
    assert (tokens.decode(sym, table) == ids).all() and len(sym) < len(ids)
    at = np.concatenate(([0], np.flatnonzero(ends) + 1))
    assert [len(tokens.decode(sym[a:b], table)) for a, b in zip(at, at[1:], strict=False)] == n_docs.tolist()
    # no pair is left that pays, or no symbol is
    pairs = collections.Counter(zip(sym[:-1][~ends[:-1]].tolist(), sym[1:][~ends[:-1]].tolist(), strict=True))
    assert max(pairs.values()) <= 9 or len(rules) >= 15_000


def test_encoder_pieces_equal_whole_texts():
    e = tokens.encoder(Q.tokenizer())
    r = random.Random(3)
    for _ in range(400):
        t = "".join(r.choice([" ", "  ", "\n", "a", "Word", "don't", "'s", "é", "!", "?!", "42", "\u00a0", "\u2028", "日本", "\x1c", "<|endoftext|>", "%%%", "ß", "ŉ"]) for _ in range(r.randint(0, 14)))
        assert e.encode([t])[0].tolist() == [*e.plain([t])[0], 0], repr(t)


# op6


def test_decontamination(spark):
    item = prose(40, 11)
    near = item.split()
    near[0] = "changed"  # 35 of 36 shingles
    items = spark.createDataFrame([(1, item), (2, "Alpha beta, gamma"), (3, None), (4, ""), (5, item), (None, prose(30, 12))], "item_id long, text string")
    rows = [(1, prose(50, 1) + " " + item.upper() + "! " + prose(10, 2)), (2, " ".join(near)), (3, prose(100, 3)), (4, None), (5, "x ALPHA  beta\ngamma y"), (6, " ".join(item.split()[:20])), (7, ""), (None, prose(30, 12)), (1, item)]
    d = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, items).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 5), (1, 1), (1, 5), (2, 1), (2, 5), (5, 2), (None, None)], key=repr)
    assert {r["doc_id"] for r in decontam.clean(d, items).collect()} == {3, 4, 6, 7}
    assert decontam.contaminated(d, items.limit(0)).count() == decontam.contaminated(d.limit(0), items).count() == 0


def test_clean_judges_texts_not_ids(spark):
    leak = prose(40, 11)
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    d = spark.createDataFrame([(None, leak, 1), (None, "clean one", 2), (4, leak, 3), (4, "clean two", 4)], "doc_id long, text string, tag int")
    assert sorted(r["tag"] for r in decontam.clean(d, items).collect()) == [2, 4]


def changed(words, r, most):
    """words with up to `most` of them changed, left out or added to."""
    out = list(words)
    for k in range(r.randint(0, min(most, len(words) - 1))):
        at = r.randrange(len(out))
        out[at : at + 1] = r.choice([[f"zz{k}"], [], [out[at], f"yy{k}"]])
    return out


def test_hamming_index_finds_what_all_windows_find():
    """Against the exact similarity of all windows with all items of their length."""
    r = random.Random(7)
    texts = [prose(n, 500 + n) for n in (6, 12, 20, 33, 33, 50, 80, 120)] + ["three short words", "one"]
    bags = [(len(w), collections.Counter(tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1))) for w in map(str.split, texts)]
    items = decontam.Items(list(enumerate(texts)))
    got = want = 0
    for k in range(200):
        text = " ".join([*prose(30, k).split(), *changed(texts[k % len(texts)].split(), r, 4), *prose(30, 900 + k).split()])
        w = decontam.WORD.findall(text)
        exact = set()
        for i, (n, bag) in enumerate(bags):
            size = min(5, n)
            for a in range(max(1, len(w) - n + 1)):
                x = collections.Counter(tuple(w[a + j : a + j + size]) for j in range(n - size + 1))
                both = (x & bag).total()
                if both >= 0.8 * (x.total() + bag.total() - both):
                    exact.add(i)
        found = {i for i, _, _ in items.hits(text, {})}
        assert found <= exact
        got, want = got + len(found), want + len(exact)
    assert want > 70 and got >= 0.98 * want


def test_item_groups_cover_all_items(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_ITEMS", 7)
    items = spark.range(40).select(F.col("id").alias("item_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    groups = decontam.item_groups(items, "text", "item_id")
    assert len(groups) > 3 and sorted(r["item"] for g in groups for r in g.collect()) == list(range(40))


def test_given_leaks_are_found(spark):
    bench = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    all_docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = {(d, i) for d, t in all_docs for i, b in bench if b in t}
    got = {(r["doc_id"], r["item_id"]) for r in Q.op6_decontamination(spark, SF).collect()}
    assert want <= got


# op7


PAGES = {
    "<title>A &amp; B</title><p>one<p>two<br>lines": ("A & B", "one\n\ntwo\nlines"),
    "<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>": (None, "- a\n- b\n\n  3. c\n  4. d"),
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>fig<td>12</table>": (None, "Name   Qty\napple  3\nfig    12"),
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": (None, "a  b\n   c"),
    "<div hidden>no</div><p style='display: NONE'>no</p><script>x<y</script><style>p{}</style><!-- c -->yes": (None, "yes"),
    "<pre>\n a\n   b</pre>t": (None, " a\n   b\n\nt"),
    "a<b>b</b> <i> c</i>": (None, "ab c"),
    "x <y": (None, "x <y"),
    "</p></div>tail": (None, "tail"),
    None: (None, ""),
    "": (None, ""),
    "<div>" * 3000 + "deep": (None, "deep"),
    "<dl><dt>t<dd>d<dt>u</dl>": (None, "t\n  d\nu"),
}


VISIBLE = {
    "<html><head><title>T</title><p>Hello": ("T", "Hello"),
    "<html><head><meta charset=x><noscript><img alt=no></noscript>\n<title>T</title>Hello<p>you": ("T", "Hello\n\nyou"),
    "<head><style>p{}</style></head>\n<body>b": (None, "b"),
    "<table>note<tr>side<td>x</table>": (None, "note side\nx"),
    "<table><b>n</b><caption>c</caption><tr><img alt=i><td>x<td>y</table>z": (None, "n i\nc\nx  y\n\nz"),
    "<table><tbody><tr><td>x</tr>late</table>": (None, "late\nx"),
    "<div>" * 196 + "<table><tr><td>deep<td>er</table>": (None, "deep  er"),
    "<div>" * 197 + "<table><tr><td>deep<td>er</table>": (None, "deep er"),
    "<div>" * 198 + "<table><tr><td>deep</table>": (None, "deep"),
    "<div>" * 199 + "<table><tr><td>deep</table>": (None, "deep"),
    "a <svg><title>no</title><desc>no</desc><defs/><path d='x'/><text>one</text><text>two</text></svg> b": (None, "a one two b"),
    "<svg><title/><text>t</text></svg> u": (None, "t u"),
    "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>": (None, "x=2"),
    "<textarea>a &lt;b>\n  c</textarea>d": (None, "a <b>\n  c\nd"),
    "<p>Pick<select><optgroup label=G><option>one<option selected>two</optgroup><option label=L>three</select>end": (None, "Pick\nG\none\ntwo\nL\nend"),
    "<desc>seen</desc><datalist><option>no</datalist>": (None, "seen"),
    "<p aria-hidden=true>seen<button>go</button>": (None, "seengo"),
    "<style>.h{display:none} p.v, #w { visibility: hidden }</style><p class='a h'>no<p class=v>no<b style='visibility:visible'>yes</b><i id=w>no</i>": (None, "yes"),
    "<style>@media print{.k{display:none}} @import 'x'; /* .k{display:none} */ div .k{display:none}</style><p class=k>kept": (None, "kept"),
    "<style>p{display:none} .s{display:block}</style><p>no<p class=s>yes<p style=display:block>too": (None, "yes\n\ntoo"),
    "<div style='visibility:hidden'>no<ul><li>no<li style='visibility:visible'>yes</ul></div>": (None, "- yes"),
    "<details><summary>More</summary>no</details><details open><summary>S</summary>yes</details>": (None, "More\nS\nyes"),
    "<a title=\"it\"s\" href='x>y'>link</a> <a href=\"x>open</a> end": (None, "link open end"),
    "<table><tr><td>" + "w " * 60 + "<td>b<tr><td>c<td>d</table>": (None, " ".join("w" * 40) + "  b\n" + " ".join("w" * 20) + "\nc" + " " * 80 + "d"),
    "<table><tr><td rowspan=300>a<td>x" + "<tr><td>y" * 299 + "</table>": (None, "a  x" + "\n   y" * 299),
    "<table><tr><td colspan=500>a<td>x<tr><td>b<td>c</table>": (None, "a     x\nb  c"),
}


@pytest.mark.parametrize("unit", ["<a '", "<a \"", "<a b=\"", "<!", "</a ", "<", "<style></style ", "<td rowspan=9 colspan=9>", "<!-- ", "<a b='\">"])
def test_html_in_linear_time(unit):
    """A megabyte of markup that never ends well."""
    start = time.perf_counter()
    html.render(unit * (1_000_000 // len(unit)) + "'\">tail")
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("page", list(VISIBLE))
def test_html_shows_what_browsers_show(page):
    assert html.render(page) == VISIBLE[page]


@pytest.mark.parametrize("page", list(PAGES))
def test_html(page):
    assert html.render(page) == PAGES[page]


def test_html_rows(spark):
    d = spark.createDataFrame([(1, None, "a"), (1, "<p>x", "b"), (None, "<p>" + "y " * 200_000, "c")], "page_id long, html string, text string")
    out = sorted(((r["page_id"], len(r["text"]), r["n_lines"]) for r in html.extract(d).collect()), key=repr)
    assert out == [(1, 0, 0), (1, 1, 1), (None, 399_999, 1)]
    assert html.extract(d.limit(0)).count() == 0


# op8


def brute_print(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    parts = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=2):
    ids = list(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, texts):
    prints = {i: brute_print(t) for i, t in texts}
    want = brute_components(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs(spark)).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


@pytest.mark.parametrize(("part", "many"), [(2048, 1 << 40), (5, 1 << 40), (5, 0)])
def test_tiles_find_every_link(spark, monkeypatch, part, many):
    """Chains of fingerprints in one tile and across tiles, whole or in parts, by 4 and by 8 segments."""
    monkeypatch.setattr(simhash, "MANY", many)
    r = random.Random(part)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            x ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
    prints = {int(np.uint64(f).astype(np.int64)): f for f in fps}
    edges = [tuple(e) for e in simhash.tile_edges(spark.createDataFrame([(k,) for k in prints], "fp long"), part=part).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 64 for a, b in edges)
    nodes = spark.createDataFrame([(k,) for k in prints], "node long")
    links = spark.createDataFrame(edges, "a long, b long")
    got = {x["node"]: x["component"] for x in common.components(nodes, links, "t").collect()}
    assert got == brute_components(dict(sorted(prints.items())))


def test_near_duplicates_odd(spark):
    d = odd_docs(spark)
    out = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(d).collect()]
    assert sorted(out, key=repr) == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (6, 6), (7, 7), (None, None), (None, 1), (8, 8), (9, 9)], key=repr)
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    kept = simhash.keep_first(d)
    assert kept.columns == d.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 6, 7, 8, 9, None], key=repr)


def test_keep_first_by_id_and_text(spark):
    x, y = prose(60, 1), prose(60, 2)
    d = spark.createDataFrame([(3, x, "a"), (5, y, "b"), (5, x, "c"), (None, x, "d"), (None, prose(60, 3), "e"), (7, y, "f"), (5, y, "b")], "doc_id long, text string, __mark string")
    for kept in (simhash.keep_first(d), simhash.keep_similar(d)):
        assert kept.columns == d.columns and sorted(r["__mark"] for r in kept.collect()) == ["a", "b", "e"]


def brute_similar(rows):
    """{id: smallest id} over links of similarity 0.8 or more."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows for w in [WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]}
    inside, parent = collections.defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, n in collections.Counter(j for s in sets[i] for j in inside[s]).items():
            if 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in sets[i]:
            inside[s].append(i)
    return {i: find(i) for i in sets}


def test_keep_similar(spark, texts):
    """Near copies by similarity: chains, a large group, texts that are alike by half, and the given documents."""
    r, rows = random.Random(2), list(texts)
    for k in range(60):
        base = prose(200, 40 + k % 3).split()
        rows.append((10_000 + k, " ".join(changed(base, r, 5))))
    half = prose(100, 77)
    rows += [(20_000 + k, half + " " + prose(60, 300 + k // 2) + ("!" if k % 2 else "")) for k in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = set(brute_similar(rows).values())
    got = {x["doc_id"] for x in simhash.keep_similar(d).collect()}
    assert len(want ^ got) <= 0.005 * len(rows)


@pytest.mark.parametrize("large", [1 << 22, 10])
def test_text_tiles(monkeypatch, large):
    """A tile's links connect what all similar pairs of different components connect."""
    monkeypatch.setattr(simhash, "LARGE", large)
    r = random.Random(5)
    base = [prose(120, k).split() for k in range(4)]
    rows = [(k % 23, k, " ".join(changed(base[k % 4], r, 6))) for k in range(40)]
    left, right = rows[:15], rows[15:]
    sets = {k: simhash.shingle_sets([t], {}, 5)[0] for _, k, t in rows}

    def joined(links):
        part = {c: c for c, _, _ in rows}
        own = {k: c for c, k, _ in rows}
        for a, b in links:
            x, y = part[own[a]], part[own[b]]
            part = {c: x if p == y else p for c, p in part.items()}
        return {frozenset(c for c in part if part[c] == p) for p in part.values()}

    similar = [(a[1], b[1]) for a in left for b in right if 10 * len(np.intersect1d(sets[a[1]], sets[b[1]])) >= 8 * len(np.union1d(sets[a[1]], sets[b[1]]))]
    assert similar and joined(simhash.text_links(left, right)) == joined(similar)


@pytest.mark.parametrize("n", [9, 20, 150])
def test_pairs_of_similarity_are_candidates(n):
    """Of pairs just above similarity 0.8, short ones too, nearly all share a band and lie within the stage's radius."""
    r, pairs, known = random.Random(n), [], {}
    while len(pairs) < 400:
        a = [f"w{r.randrange(5000)}" for _ in range(n)]
        b, last = list(a), None
        own = simhash.shingle_sets([" ".join(a)], known, 5)[0]
        while True:
            k = r.randrange(len(b))
            b = r.choice([b[:k] + [f"new{r.randrange(10**6)}"] + b[k + 1 :], b[:-1], [*b, f"new{r.randrange(10**6)}"]])
            other = simhash.shingle_sets([" ".join(b)], known, 5)[0]
            if 10 * len(np.intersect1d(own, other)) < 8 * len(np.union1d(own, other)):
                break
            last = other
        if last is not None:
            pairs.append((own, last))

    def keys(sets):
        size = np.array(list(map(len, sets)))
        return band_keys(((np.concatenate(sets) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32), np.cumsum(size) - size)

    band = (keys([x for x, _ in pairs]) == keys([y for _, y in pairs])).any(1)
    near = np.array([(simhash.majority(x) ^ simhash.majority(y)).bit_count() <= simhash.WIDE for x, y in pairs])
    assert near.mean() >= 0.995 and (near & band).mean() >= 0.99


def test_keep_similar_odd(spark):
    d = odd_docs(spark)
    kept = simhash.keep_similar(d)
    assert kept.columns == d.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 6, 7, 8, 9, None], key=repr)
    assert simhash.keep_similar(empty_docs(spark)).count() == 0


def test_keep_near_has_links_of_fingerprints_and_of_texts(spark, texts):
    import corpus_pipeline

    loop = "a b c " * 60  # fingerprints are of the repeated shingles, sets mostly of the others
    rows = [*texts, (30_000, loop + prose(6, 901)), (30_001, loop + prose(6, 902)), (30_002, prose(6, 903) + " " + loop)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    similar, near = brute_similar(rows), {x["doc_id"]: x["component_id"] for x in simhash.near_duplicates(d).collect()}
    assert len({similar[k] for k in (30_000, 30_001, 30_002)}) == 3 and near[30_002] == 30_000
    got = {x["doc_id"] for x in corpus_pipeline.dedup_stage(spark, d, SF).collect()}
    assert len(got) == len({near[i] for i in got})  # one at most of what fingerprints link
    both = brute_components_of([(i, c) for i, c in similar.items()] + list(near.items()))
    assert len({both[i] for i, _ in rows} ^ got) <= 0.005 * len(rows)


def brute_components_of(links):
    """{id: smallest id} over links."""
    low = {i: i for x in links for i in x}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


# op9


def test_language(spark):
    out = langid.predict(docs(spark)).join(docs(spark).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


@pytest.mark.parametrize("key", [None, 7])
@pytest.mark.parametrize("most", [5, 20, 4000])
def test_languages_of_texts_under_one_id(spark, key, most):
    """The sample is drawn by id and text, so rows of one id are not all in or all out."""
    r = random.Random(8)
    word = lambda letters: "".join(r.choice(letters) for _ in range(6))
    data = [(key, " ".join(word("aehilnorst") for _ in range(40)), "en") for _ in range(30)] + [(key, " ".join(word("bcdfgküäöß") for _ in range(40)), "de") for _ in range(30)]
    out = langid.predict(spark.createDataFrame(data, "doc_id long, text string, lang string"), max_train=most).collect()
    assert collections.Counter(r["lang_pred"] for r in out) == {"en": 30, "de": 30}


def test_language_reads_only_the_text(spark):
    d = docs(spark)
    other = d.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    pick = lambda x: sorted(tuple(r) for r in langid.predict(x).collect())
    assert pick(d) == pick(other)


def test_language_odd(spark):
    out = langid.predict(odd_docs(spark)).collect()
    assert len(out) == 12 and sum(r["lang_pred"] == "und" for r in out) == 4
    assert all(r["score"] == 0 for r in out if r["lang_pred"] == "und")
    unlabelled = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predict(unlabelled).collect()} == {"und"}
    assert langid.predict(empty_docs(spark)).count() == 0


def brute_grams(text, bits=16):
    """Buckets of all n-grams, one by one."""
    codes, out = [ord(c) for c in text.lower()], []
    for n in langid.ORDERS:
        for k in range(len(codes) - n + 1):
            h = 0
            for j in range(n):
                h = (h * 0x01000193 + (codes[k + j] + j + 1) * 0x9E3779B1) % 2**32
            out.append(((h ^ h >> 15) * 0x85EBCA6B) % 2**32 >> 32 - bits)
    return collections.Counter(out)


@pytest.mark.parametrize("chunk", [1 << 20, 37, 5])
def test_ngrams_of_batches(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    texts = [prose(50, 1), None, "", "Ab", prose(9, 2), "x", "日本語"]
    got = [collections.Counter() for _ in texts]
    for owner, b in langid.grams(texts):
        for k, x in zip(owner.tolist(), b.tolist(), strict=True):
            got[k][x] += 1
    assert got == [brute_grams(t or "") for t in texts]


def test_scores_are_sums_over_ngrams():
    model = np.random.default_rng(1).normal(-5, 2, ((1 << 16) + 1, 3)).astype(np.float32)
    texts = [prose(40, 3), None, prose(300, 4)]
    for t, got in zip(texts, langid.score(texts, model), strict=True):
        want = model[-1].astype(float) + sum((n * model[b].astype(float) for b, n in brute_grams(t or "").items()), np.zeros(3))
        assert got == pytest.approx(want, rel=1e-5)


def test_more_languages_than_a_model_holds(spark, monkeypatch):
    want = sorted(tuple(r) for r in langid.predict(docs(spark)).collect())
    monkeypatch.setattr(langid, "BLOCK_LANGS", 1)
    got = sorted(tuple(r) for r in langid.predict(docs(spark)).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-6)


# op10


def brute_counts(text):
    t = text or ""
    w = WORDS.findall(t)
    grams = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = {j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    some = [x for x in t.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(some) - len(set(some)), len(again)


def test_quality_counts(spark):
    for d in (docs(spark), odd_docs(spark)):
        for r in quality.count_features(d, carry=("doc_id", "text")).collect():
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(r["text"])
    loop = spark.createDataFrame([(1, "a b c a b c a b"), (2, "a a a a"), (3, "a b"), (4, "x\nx\n \nx y")], "doc_id long, text string")
    for r in quality.count_features(loop, carry=("doc_id", "text")).collect():
        assert r["n_repeat_words"] == brute_counts(r["text"])[4] and r["n_dup_lines"] == brute_counts(r["text"])[3]


def test_quality_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    out = Q.op10_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    good, bad = [r for r in out if r["quality"]], [r for r in out if not r["quality"]]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good) and sum(r["kept"] for r in bad) <= 0.2 * len(bad)


def test_rules_are_conjunctions_where_one_threshold_is_not_enough(spark):
    """Rows are bad only with many symbols and few distinct words."""
    r = random.Random(4)
    data = []
    for k in range(1200):
        s, u = r.randint(0, 90), r.randint(10, 100)
        data.append((100, 500, s, 0, 0, u, 0, 500, 0, s > 50 and u < 40, k % 3 > 0))
    df = spark.createDataFrame(data, ", ".join(f"{c} long" for c in quality.COUNTS) + ", reject boolean, grow boolean")
    learned = quality.learn(df)
    assert learned.rules and any(len(rule) > 1 for rule in learned.rules)
    wrong = df.filter(learned.expression().isNotNull() != F.col("reject")).count()
    assert wrong < 0.1 * sum(x[-2] for x in data)


def test_quality_odd(spark):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (7, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_rules(odd_docs(spark), labels).collect()
    assert len(out) == 12 and all(r["kept"] == (not r["base_failed"]) for r in out)
    kept = quality.keep_good(odd_docs(spark), labels)
    assert kept.columns == odd_docs(spark).columns and kept.count() == sum(r["kept"] for r in out)
    assert quality.quality_rules(empty_docs(spark), labels).count() == 0


# pipeline and registry


def test_pipeline(spark):
    import corpus_pipeline

    first = docs(spark)
    seen = {}
    d = first
    for name, stage in corpus_pipeline.STAGES:
        d = common.cut(stage(spark, d, SF), "t")
        seen[name] = d
    good, unique, clean, mixed, out = seen.values()
    assert good.columns == unique.columns == clean.columns == mixed.columns == first.columns
    judged = {r["doc_id"]: r["kept"] for r in Q.op10_quality_rules(spark, SF).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, k in judged.items() if k}
    classes = brute_similar([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(set(classes.values()))
    leaks = {r["doc_id"] for r in decontam.contaminated(unique, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in unique.collect()} - leaks
    assert out.count() == mixed.count() == sum(r["copies"] for r in mixing.mix(clean).collect())
    whole = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == sorted(tuple(r) for r in out.collect())


def test_every_numbered_query_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_components_of_long_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(300)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5, 5)], "a long, b long")
    nodes = spark.createDataFrame([(k,) for k in [*range(301), *range(1000, 1300), 7777]], "node long")
    got = {r["node"]: r["component"] for r in common.components(nodes, edges, "t").collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1300), 1000), 7777: 7777}


def test_random_access_to_token_blocks(spark, tmp_path):
    """Single documents and ranges of ids, from blocks of a few documents, equal the library's own ids."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(Q.tokenizer())
    texts = [(k if k % 9 else None if k % 2 else 5, ("the cat sat on the mat again and again " * (k % 13) + f"number {k}") if k % 11 else None) for k in range(1, 90)]
    path = str(tmp_path / "blocks")
    tokens.write_blocks(spark.createDataFrame(texts, "doc_id long, text string"), path, Q.tokenizer(), block=400)
    blocks = spark.read.parquet(path)
    assert blocks.count() > 10
    ids = lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, tokens.END]
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    flat, want = [], []
    for k, t in order:
        if k in (5, 14, 77, None):
            want.append((k, len(flat), ids(t)))
        flat += ids(t)
    asked = spark.createDataFrame([(5,), (14,), (77,), (77,), (None,), (100_000,)], "doc_id long")
    got = [(r["doc_id"], r["start"], r["ids"]) for r in tokens.read_documents(blocks, asked).orderBy("start").collect()]
    assert got == want
    for a, b in ((0, 1), (3, 1200), (len(flat) - 2, len(flat) + 50), (700, 700), (0, len(flat))):
        piece = [x for r in tokens.read_range(blocks, a, b).orderBy("start").collect() for x in r["ids"]]
        assert piece == flat[a:b]
    assert tokens.read_range(blocks, 3, 9).first()["start"] == 3
    assert tokens.read_documents(blocks.limit(0), asked).count() == 0 == tokens.read_range(blocks.limit(0), 0, 5).count()


def test_repeats_in_long_periodic_texts(spark):
    """A text with a cell a byte takes several rows of cells, and few spans; it loses all, and its copy too."""
    n = 3 * repeats.PER_ROW
    found = list(repeats.rows_of(1, 2, "a" * n, repeats.LENGTH))
    assert len(found) == 3 and [r[2] for r in found] == [n, None, None] and max(len(r[4]) for r in found) == repeats.PER_ROW
    assert [r[2] for r in repeats.rows_of(1, 2, "short", repeats.LENGTH)] == [5]
    rows = [(1, "a" * n), (2, "ab" * 5000 + prose(200, 31)), (3, prose(300, 32)), (4, None), (None, "x" * 399), (5, "y" * 400), (6, "z" * 401)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in repeats.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert got[1] == (n, n, 1) and got[2][1:] == (10_000, 1) and got[3][1:] == (0, 0) and got[4] == (0, 0, 0)
    assert got[None][1:] == (0, 0) and got[5][1:] == (0, 0) and got[6] == (401, 401, 1)
