"""Each corpus operator on a small fixture, against brute force, with nulls, empties, ties and clashing columns."""

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pricepanel.llm import common, decontaminate, html_extract, ngram_join, packing, quality_knn, quality_rules, substring_dedup, token_codes, toxicity, url_filters
from pricepanel.llm.common import held_out, tokenizer_path

SCHEMA = "doc_id long, text string, _doc string, n_words string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(300)]
    make = lambda n: " ".join(rng.choices(words, k=n))
    base, line = make(120), make(26)
    out = [base, base, base + " tail", "x y z " + base, make(80) + "\n" + line, line + "\t" + make(60), None, "", " \n ", "one", "one", "a b c d", "A B C D", ("En " * 90).strip(), "a b " * 60]
    for i in range(12):
        near = base.split()
        near[10 * i % 120] = f"edit{i}"
        out.append(" ".join(near))
    out.append(make(3000))
    return [*out, *[make(rng.randint(1, 90)) for _ in range(40)]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "own", "own") for i, t in enumerate(texts)], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup(docs, texts, none):
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(docs, many=5, shard_words=50, keep=("_doc",)).collect()}
    seen, removed = set(), 0
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            w = tuple(words[k : k + 20])
            if w in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(w)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_text"], got[i]["_doc"]) == (len(words), sum(gone), kept, "own")
        removed += sum(gone)
    assert removed > 500
    assert substring_dedup.substring_dedup(none).count() == 0


def test_substring_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (2, text)]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 30)]


def test_substring_dedup_keeps_texts_of_one_id_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 60), ("b", 60), ("c", 22)))
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, c), (3, c), (3, a + " " + c)], "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(df).collect())
    first_of_3 = got[3, 82, 60]  # c + a goes by the hashes of the two texts of 3
    assert got[1, 60, 0] == 1 and got[2, 60, 60] == 1 and got[2, 60, 0] == 1
    assert (first_of_3, got[3, 22, 22]) == (1, 2) or (got[3, 82, 82], got[3, 22, 0]) == (1, 2)


def test_word_hashes_are_by_word():
    rng = random.Random(2)
    for lower in (False, True):
        for _ in range(60):
            texts = [None if rng.random() < 0.1 else "".join(rng.choices("abAB é \n\t\u00a0", k=rng.randint(0, 40))) for _ in range(rng.randint(0, 9))]
            words = [(t or "").encode().lower().split() if lower else (t or "").encode().split() for t in texts]
            each = common.word_hashes(pa.array([w.decode() for x in words for w in x], pa.string()), lower)[0]
            for chunk in (3, 1 << 16):
                hashes, places = common.word_hashes(pa.array(["q w", *texts, "z"], pa.string()).slice(1, len(texts)), lower, chunk)
                assert np.diff(places).tolist() == [len(w) for w in words] and (hashes == each).all()
    h = common.word_hashes(pa.array(["ab ba aab " + "a" * 9000, "a" * 9000]))[0]
    assert len(set(h.tolist())) == 4 and h[3] == h[4]


def test_automaton_is_matching_statistics():
    rng = random.Random(1)
    for _ in range(30):
        automaton, before = substring_dedup.Automaton(), []
        for _ in range(4):
            s = [rng.choice("ab") for _ in range(rng.randint(1, 30))]
            flags = automaton.stream(s, 5)
            for j in range(len(s)):
                w = s[j - 4 : j + 1] if j >= 4 else None
                earlier = [p[a : a + 5] for p in before for a in range(len(p) - 4)] + [s[a : a + 5] for a in range(max(0, j - 4))]
                assert flags[j] == (w is not None and w in earlier)
            before.append(s)


def brute_components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_ngram_join(docs, texts, none):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs, buckets=4096).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert ngram_join.jaccard_components(none, buckets=4096).count() == 0


def test_ngram_join_of_many_alike_and_hot_shingles(spark):
    """Near copies that link in chains, and a line that all texts have; hot shingles are dealt out."""
    rng = random.Random(13)
    base = [f"w{rng.randint(0, 400)}" for _ in range(60)]
    texts, now = [], list(base)
    for i in range(120):
        if i % 3 == 0:
            now[rng.randrange(60)] = f"step{i}"
        texts.append("the same line in all of them here " + " ".join(now if i % 2 else base[:30] + [f"u{i}x{j}" for j in range(8)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for rounds in (0, 2):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs, buckets=4096, rounds=rounds, hot_from=3).collect()}
        assert [got[i] for i in range(len(texts))] == brute_components(texts)


def test_ngram_join_deals_large_groups_and_leaves_one_table(spark, texts, monkeypatch):
    """The pairwise rest in parts of two rows a side gives the same components; of all its tables the result stays."""
    monkeypatch.setattr(ngram_join, "_MEET", 2)
    rng = random.Random(4)
    shared = " ".join(f"s{i}" for i in range(8))
    # Each text shares a rare run with all others and is alike with one of them only.
    more = [f"{shared} " + " ".join(f"t{i // 2}x{j}" for j in range(40)) + f" end{rng.random()}" for i in range(40)]
    held = spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")
    there = set(Path(common.shared_folder(spark)).glob("*"))
    rows = ngram_join.jaccard_components(held, buckets=4096, rounds=0, hot_from=3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows.collect()}
    assert [got[i] for i in range(len(got))] == brute_components(texts + more)
    left = set(Path(common.shared_folder(spark)).glob("*")) - there
    assert [x.name.rpartition("-")[0] for x in left] == ["components"]


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 64, rng.integers(1, 900), dtype=np.uint64))
        y = np.unique(np.concatenate([rng.choice(x, len(x) // 2, replace=False), rng.integers(0, 1 << 64, rng.integers(1, 300), dtype=np.uint64)]))
        parts = [ngram_join.parts_of(ngram_join.sketch(z), len(z)) for z in (x, y)]
        assert ngram_join.least_difference(*parts) <= len(np.setxor1d(x, y))


def test_suffix_filter_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(2))
        true = len(np.setxor1d(x, y))
        assert ngram_join.suffix_filter(x, y, 1000) <= true


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "_a long, _b long")
    got = {r["_node"]: r["_least"] for r in ngram_join.components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


def test_quality_rules(spark, docs, texts, none):
    got = {r["doc_id"]: r for r in quality_rules.ledger(docs).collect()}
    for i, t in enumerate(texts):
        w = (t or "").encode().split()
        c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = [False] * len(w)
        for k in range(len(w) - 4):
            if c[tuple(w[k : k + 5])] > 1:
                covered[k : k + 5] = [True] * 5
        assert (got[i]["n_words"], got[i]["n_repeat_words"]) == (len(w), sum(covered))
        assert bool(got[i]["failures"] & quality_rules.BASE.mask) == (len(w) < 10 or 100 * sum(covered) > 20 * len(w))
    odd = [(1, "own", "x " * 30_000, "mine"), (1, "own", "x " * 30_000, "mine"), (None, None, None, "mine")]
    odd_rows = quality_rules.ledger(spark.createDataFrame(odd, "doc_id long, _words string, text string, n_words string"))
    seen = [(r["_words"], r["n_words_in"], r["n_words"], r["n_repeat_words"]) for r in odd_rows.orderBy("n_words").collect()]
    assert seen == [(None, "mine", 0, 0), ("own", "mine", 30_000, 30_000), ("own", "mine", 30_000, 30_000)]
    assert quality_rules.ledger(none).count() == 0 and "_doc" in quality_rules.ledger(none).columns
    rows = quality_rules.ledger(docs).select("failures")
    policy = quality_rules.POLICIES[1]
    counts = {r["rule"]: (r["n_failed"], r["n_alone"]) for r in quality_rules.ablation(rows, policy).collect()}
    failures = [r["failures"] for r in rows.collect()]
    assert counts["few_words"] == (sum(f & 1 for f in failures), sum(f == 1 for f in failures))
    every = {(r["policy"], r["rule"]): tuple(r[2:]) for r in quality_rules.ablations(rows).collect()}
    bits = {name: 1 << i for i, (name, _) in enumerate(quality_rules.RULES)}
    own = {p: [f & p.mask for f in failures] for p in quality_rules.POLICIES}
    assert every == {(p.version, r): (sum(f & bits[r] > 0 for f in own[p]), sum(f == bits[r] for f in own[p]), own[p].count(0), sum(f in (0, bits[r]) for f in own[p])) for p in quality_rules.POLICIES for r in p.rules}
    assert {rule: v[:2] for (version, rule), v in every.items() if version == policy.version} == counts
    assert quality_rules.ablations(rows.limit(0)).count() == 0


def brute_leaks(docs, items, k=5, t=0.75):
    """Every window of every text with every item, bags of shingles compared."""

    def shingles(words, size):
        return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]

    out = {}
    for i, item in items:
        words = (item or "").lower().split()
        if not words:
            continue
        size = min(k, len(words))
        bag = Counter(shingles(words, size))
        m = bag.total()
        for d, text in docs:
            own = shingles((text or "").lower().split(), size)
            for at in range(max(1, len(own) - m + 1)):
                window = Counter(own[at : at + m])
                both = (window & bag).total()
                if window and both / (window | bag).total() >= t - 1e-12:
                    out[d, i] = max(out.get((d, i), 0), both / (window | bag).total())
    return out


def test_decontamination(spark):
    rng = random.Random(9)
    make = lambda n, kinds=90: [f"q{rng.randint(0, kinds)}" for _ in range(n)]
    items = [(i, make(n)) for i, n in enumerate((15, 22, 40, 59, 60, 12, 5, 30))] + [(20, make(40, 3))]
    docs, n = [], 0
    for i, words in items:
        for kind in range(24):
            text = list(words)
            for _ in range(kind // 6):
                at = rng.randrange(len(text))
                text[at : at + 1] = [[f"edit{n}"], [], [text[at], f"more{n}"]][rng.randrange(3)]
            if kind % 8 == 7:
                text = text[len(text) // 2 :] + text[: len(text) // 2]  # two halves, the other way round
            docs.append((n, " ".join([*make(rng.randint(0, 30), 900), *text, *make(rng.randint(0, 30), 900)]).title()))
            n += 1
    docs += [(n, " ".join(items[2][1][:20])), (n + 1, None), (n + 2, ""), (n + 3, "only three words"), (n + 4, "here are only three words more"), (n + 5, " ".join(make(2000, 900) + items[4][1]))]
    rows = [(i, " ".join(words)) for i, words in items] + [(7, None), (8, ""), (9, "Only three words")]
    bench = spark.createDataFrame([(*r, "own") for r in rows], "item_id long, text string, _key string")
    frame = spark.createDataFrame([(*d, "own") for d in docs], "doc_id long, text string, _w string").repartition(3)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(frame, bench).collect()}
    true = brute_leaks(docs, rows)
    assert len(true) > 60 and (n + 4, 9) in true
    assert set(got) <= set(true)
    assert len(got) >= 0.99 * len(true)  # beyond the radius of the fingerprints a window may be lost
    assert all(got[p] == pytest.approx(true[p]) for p in got)
    assert decontaminate.leaks(frame.limit(0), bench).count() == 0 and decontaminate.leaks(frame, bench.limit(0)).count() == 0


def test_decontamination_judges_rows(spark):
    item, other = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    bench = spark.createDataFrame([(None, item), (1, item), (1, "b0 b1 b2 b3 b4 b5 b6")], "item_id long, text string")
    rows = [(1, item), (1, other + " end"), (1, "clean text"), (None, "x " + item), (None, "clean"), (2, None), (3, item + " " + item), (3, item + " " + item)]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, similarity string")
    left = sorted((r["doc_id"] or 0, r["text"] or "", r["similarity"]) for r in decontaminate.clean(docs, bench).collect())
    assert left == [(0, "clean", "own"), (1, "clean text", "own"), (2, "", "own")]
    got = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect())
    assert got == Counter([(1, None), (1, 1), (3, None), (3, 1)])


def test_token_codes(docs, texts, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    got = {r["doc_id"]: r for r in token_codes.read_codes(token_codes.write_codes(docs, tokenizer_path(), shard_tokens=500)).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_codes.read_codes(token_codes.write_codes(none, tokenizer_path())).count() == 0


def test_token_codes_and_packing_of_null_and_repeated_ids(spark):
    rows = [(2, "b b", "x"), (1, "a", "x"), (1, "a", "x"), (1, None, "x"), (None, "long " * 900, "x"), (None, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(2)
    coded = token_codes.Encoder(tokenizer_path())([t for _, t, _ in rows])
    wanted = Counter((d, len(e) // 4, zlib.crc32(e)) for (d, _, _), e in zip(rows, coded))
    got = token_codes.read_codes(token_codes.write_codes(docs, tokenizer_path(), shard_tokens=3)).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == wanted
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    packed = packing.pack(docs, tokenizer_path(), capacity=256).collect()
    assert sum(r["length"] for r in packed) == at and len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)


def test_codes_read_at_random_from_the_stored_shards(spark, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for shard in token_codes.write_codes(docs, tokenizer_path(), shard_tokens=500).collect():
        codes = token_codes.Codes(shard["codes"])
        for doc, start, end in zip(shard["doc_ids"], shard["starts"], [*shard["starts"][1:], len(codes)]):
            ids = [*plain.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
            assert [codes[start + j] for j in range(0, end - start, 5)] == ids[::5]


def test_codes_random_access_and_odd_texts():
    from tokenizers import Tokenizer

    ids = np.random.default_rng(0).integers(0, 1 << 20, 3000)
    codes = token_codes.Codes(token_codes.pack_codes(ids))
    assert (codes.all() == ids).all() and [codes[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
    assert len(token_codes.Codes(token_codes.pack_codes(np.zeros(0, np.uint32)))) == 0
    plain, encode = Tokenizer.from_file(tokenizer_path()), token_codes.Encoder(tokenizer_path())
    rng = random.Random(3)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "1", "½", "'s", "'", ".", "...", " ", " ", "\x1c", "\x85", "\u2009", "<|endoftext|>", "你", "\r", "\u00a0", "\x0b", "word", "?!"]
    mixed = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)]
    assert encode(mixed) == [np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in mixed]
    odd = ["  a", "a  b ", "\n \n x", "a <|endoftext|> b", "it's 12½ é　x", "\x1c a", "word" * 50]
    assert encode(odd) == [np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in odd]


def test_packing(docs, texts, none):
    rows = packing.pack(docs, tokenizer_path(), capacity=256).collect()
    encoded = token_codes.Encoder(tokenizer_path())(texts)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        part = encoded[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"] and (r["length"] == 256 or r["piece"] == 0)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(len(e) // 4 for e in encoded)
    assert sum(r["length"] for r in rows) == total and len(sequences) <= -(-total // 256) + 2
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_packing_plan_places_everything():
    rng = random.Random(5)
    histogram = {n: rng.randint(1, 40) for n in rng.sample(range(1, 2049), 300)}
    p = packing.plan(histogram, 2048)
    decreasing = packing.Plan(histogram, 2048)
    decreasing.best_fit(sorted(histogram, reverse=True))
    assert all(v == 0 for v in p.left.values()) and p.sequences <= decreasing.sequences
    for small in (2, 3, 4):
        assert all(v == 0 for v in packing.grouped_plan(histogram, 2048, 64, small).left.values())


def test_html():
    page = "<html><head><title>t</title><style>p{{}}</style><script>var t='</p>'</script></head><body><nav><a>Home</a></nav><div class='ad'>buy</div><div class=top>Fixed line</div><div class=main><h1>{0}</h1><p>First &amp; {0}<br>more {0}<p>Second   {0}</div><div id=comments>nice</div><footer>f</footer>"
    pages = [page.format(x * 40) for x in "abcd"]
    w = html_extract.induce(pages)
    assert html_extract.extract(pages[0], w) == "\n".join(["a" * 40, "First & " + "a" * 40 + " more " + "a" * 40, "Second " + "a" * 40])
    assert "a" * 40 in html_extract.extract(pages[0], html_extract.induce([pages[0]] * 4))
    for bad in (None, "", "<", "<p", "text", "<div>" * 500, "</p></div>", "<script>x"):
        assert isinstance(html_extract.extract(bad, html_extract.Wrapper()), str)


def test_html_constant_texts_inside_an_article_go():
    page = "<body><article><h1>{0}</h1><p>{0} {0}</p><p>Sign up for our letter</p><div>Posted with care</div></article></body>"
    pages = [page.format(x * 40) for x in "abcdefgh"]
    w = html_extract.induce(pages)
    assert [html_extract.extract(p, w) for p in pages] == [f"{x * 40}\n{x * 40} {x * 40}" for x in "abcdefgh"]


def test_html_counts_all_pages_of_a_host(spark):
    page = "<body><div class=top>Fixed line</div><div class=text><h1>{0}</h1><p>{0} {0}</p></div></body>"
    other = "<body><section class=list><p>Other line</p><p>{0} {0}</p></section></body>"
    own = lambda i: f"own{i}x" * 12
    rows = [(i, f"http://two/{i}", page.format(own(i))) for i in range(2)]
    rows += [(i, f"http://many/{i}", (other if i % 20 == 7 else page).format(own(i))) for i in range(100, 200)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {i: f"{own(i)} {own(i)}" if i >= 100 and i % 20 == 7 else f"{own(i)}\n{own(i)} {own(i)}" for i, _, _ in rows}


def test_html_alignment_chooses_among_equal_texts():
    page = "<body><div><p>Read on</p><p>{0}</p>{1}</div></body>"
    w = html_extract.induce([page.format(x * 40, "") for x in "abcd"])
    assert html_extract.extract(page.format("e" * 40, "<p>Read on</p>"), w).count("Read on") == 1


def test_html_names_drop_no_article_text(spark):
    inside = "<body><article><header class='entry-header'><h1 class=header>{0}</h1></header><section class=related-work><p>{1} {0}</p></section><div class=share>Share this page</div></article></body>"
    plain = "<body><div class=text><h1 class=masthead>{0}</h1><p>{1} {0}</p>{2}</div><div class=related>{1}</div></body>"
    own = lambda i: f"own{i}x" * 9
    odd = "<div class=search-results>Found here</div>"
    rows = [(i, f"http://a/{i}", inside.format(own(i), own(-i))) for i in range(1, 6)] + [(i, f"http://b/{i}", plain.format(own(i), own(-i), odd if i == 11 else "")) for i in range(11, 16)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{own(i)}\n{own(-i)} {own(i)}" + ("\nFound here" if i == 11 else "") for i, _, _ in rows}
    for lot in (rows[:5], rows[5:]):
        w = html_extract.induce([h for _, _, h in lot])
        assert [html_extract.extract(h, w) for _, _, h in lot] == [got[i] for i, _, _ in lot]


def test_html_long_lists_and_short_articles():
    lines = "".join(f"<p>Rule {i} of the house</p><p>Next</p>" for i in range(300))
    page = "<body><div class=text><p>{0}</p>" + lines + "</div></body>"
    pages = [page.format(x * 9) for x in "abcd"]
    w = html_extract.induce(pages)
    assert [html_extract.extract(p, w) for p in pages] == [x * 9 for x in "abcd"]
    more = pages[0].replace("<p>Rule 7 of", "<p>Inserted</p><p>Next</p><p>Rule 7 of")
    assert html_extract.extract(more, w).split("\n") == ["aaaaaaaaa", "Inserted", "Next"]


def test_html_alignment_tells_menu_from_article_by_itself(spark):
    """Neutral names: only what the pages of the host share tells them apart; brute force takes the texts of fewer than half of them."""
    import re

    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    fixed = [" ".join(word() for _ in range(4)) for _ in range(6)]
    rows, pieces = [], []
    for i in range(9):
        own = [" ".join(word() for _ in range(rng.randint(8, 30))) for _ in range(rng.randint(2, 6))]
        inside = own + ([fixed[4]] if i % 4 else [])
        body = "".join(f"<div class=k><p>{t}</p></div>" for t in inside)
        rows.append((i, f"http://h/{i}", f"<body><div class=a><span>{fixed[0]}</span><div>{fixed[1]}</div></div><div class=b>{body}</div><div class=c>{fixed[2]}<p>{fixed[3]}</p></div></body>"))
        pieces.append((own, re.findall(r">([^<]+)<", rows[-1][2])))
    often = Counter(t for _, texts in pieces for t in set(texts))
    brute = ["\n".join(t for t in texts if 2 * often[t] < len(rows)) for _, texts in pieces]
    assert brute == ["\n".join(own) for own, _ in pieces]
    frame = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_extract.extract_articles(frame).collect()}
    assert [got[i] for i, _, _ in rows] == brute
    w = html_extract.induce([h for _, _, h in rows])
    assert len(w.template) == 5 and [html_extract.extract(h, w) for _, _, h in rows] == brute
    assert html_extract.extract_articles(frame.limit(0)).count() == 0


def test_html_whole_page_in_a_form_or_a_telling_name():
    para = "<p>" + "words of the article " * 20 + "</p>"
    for page in (f"<body><form id=f><div><h1>Title</h1>{para}</div><input></form></body>", f"<body><nav>menu</nav><div class='long-form'><h1>Title</h1>{para}</div></body>", f"<body><div class=social-science><h1>Title</h1>{para}</div></body>", f"<body><div class=article-header><h1>Title</h1></div><div class=x>{para}</div></body>"):
        assert html_extract.extract(page, html_extract.Wrapper()).startswith("Title\nwords of the article"), page
    assert html_extract.extract(f"<body><div>{para}</div><form>Your name</form></body>", html_extract.Wrapper()).startswith("words")
    deep = ["<div>" * 3000 + f"<p>own {x * 30}</p><p>the same</p>" + "</div>" * 3000 for x in "abcd"]
    w = html_extract.induce(deep)
    assert [html_extract.extract(p, w) for p in deep] == ["own " + x * 30 for x in "abcd"]
    assert html_extract.induce([f"<div class={'n' * 70}{x}><p>{x * 30}</p><p>same</p></div>" for x in "ab"]).template == {}  # long names differ at their ends
    long = "<article>" + "".join(f"<p>Line {i}</p>" for i in range(30_000)) + "</article>"
    assert html_extract.extract(long, html_extract.Wrapper()).count("\n") == 29_999


def test_html_matching_is_the_best_in_order():
    rng = random.Random(8)
    for _ in range(200):
        x, y = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        longest = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, c in enumerate(x):
            for j, d in enumerate(y):
                longest[i + 1][j + 1] = longest[i][j] + 1 if c == d else max(longest[i][j + 1], longest[i + 1][j])
        tree = html_extract.wrapper_of([("div\x1fp", html_extract.hashed(c), i, i, 1) for i, c in enumerate(x)], None, 2).tree or html_extract.Node("#root")
        pairs = []
        assert html_extract.match(tree, html_extract.parse("<div>" + "".join(f"<p>{d}</p>" for d in y) + "</div>"), pairs) == longest[-1][-1] == len(pairs)


def test_html_rows(spark):
    rows = [(1, "http://h/1", "<article><p>one two</article>"), (2, None, None), (3, "x", ""), (1, "http://h/1", "<article><p>one two</article>")]
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == [(1, "one two", 7), (1, "one two", 7), (2, "", 0), (3, "", 0)]


def test_url_filters(spark):
    rows = [("HTTP://A.net/x", "a.net", "/x", "net/", "block"), ("http://b.example.net/en/1?q#f", "b.example.net", "/en/1", "example.net/en/", "allow"), ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("http://c.org/fr/a", "c.org", "/fr/a", "org/fr/", "allow"), ("http://xnet/", "xnet", "/", None, "allow"), ("http://net", "net", "", None, "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("http://a.com/Casino/x", "a.com", "/Casino/x", None, "block")]
    df = spark.createDataFrame([(i, r[0], "own") for i, r in enumerate(rows)], "page_id long, url string, _rest string")
    got = [tuple(r) for r in url_filters.filter_urls(df).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]
    assert got == [r[1:] for r in rows]
    kept = url_filters.filter_urls(df.withColumnRenamed("url", "host"), url_col="host")
    assert [r["_rest"] for r in kept.collect()] == ["own"] * len(rows) and "host_in" in kept.columns
    assert sorted((r["page_id"], r["verdict"]) for r in kept.collect()) == [(i, r[4]) for i, r in enumerate(rows)]
    assert url_filters.filter_urls(df.limit(0)).count() == 0 and url_filters.filter_urls(df, host_rules=(), pattern_rules=()).where("verdict = 'allow'").count() == len(rows)
    for rule in url_filters.PATTERN_RULES:
        assert rule.tokens and all(t == t.lower() and t.isalnum() for t in rule.tokens)


def test_url_patterns_as_if_each_ran_on_every_url(spark):
    import re

    rng = random.Random(7)
    parts = "banner banners banner300x250 .gif .png .JPG .jpeg ads /ads/ casino .casino- login cart search /search? q= ?q= &q= ?utm_source=feed &print=1 ?print=1 .exe / . - ? # & a1 x_".split()
    urls = ["http://h.xyz/" + "".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(6000)] + ["http://h.xyz/banner300x250.png", "http://h.xyz/banners.gif"]
    rules = url_filters.PATTERN_RULES
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["pattern"], r["t"]) for r in url_filters.filter_urls(df).select("page_id", "pattern", url_filters.tokens_of(df["url"]).alias("t")).collect()}
    met = Counter()
    for i, u in enumerate(urls):
        fits = [r for r in rules if re.search(r.pattern, u)]
        assert got[i][0] == (fits[0].name if fits else None), u
        for r in fits:
            met[r.name] += 1
            assert (any if r.any_of else all)(t in got[i][1] for t in r.tokens)
    assert len(met) == len(rules) and min(met.values()) > 10
    always = url_filters.PatternRule("any x", "x", ())
    assert {r["pattern"] for r in url_filters.filter_urls(df.limit(3), pattern_rules=(always,)).collect()} == {"any x"}


def test_url_rules_of_any_number(spark):
    """Thousands of rules: the same as if each were tried on every URL."""
    hosts = tuple(url_filters.HostRule(f"h{i}.net", f"/p{i % 3}", "block" if i % 2 else "allow") for i in range(12_000))
    patterns = tuple(url_filters.PatternRule(f"r{i}", f"/tok{i}x(?:/|$)", (f"tok{i}x",)) for i in range(2_000))
    urls = [f"http://a.b.h{i}.net/p{i % 4}/tok{i // 6}x" for i in range(0, 12_100, 50)] + ["http://h5.net", None, "http:///tok1x"]
    got = {r["page_id"]: (r["rule"], r["pattern"], r["verdict"]) for r in url_filters.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), host_rules=hosts, pattern_rules=patterns).collect()}
    for n, i in enumerate(range(0, 12_100, 50)):
        rule = f"h{i}.net/p{i % 3}" if i < 12_000 and i % 4 == i % 3 else None
        pattern = None if rule or i // 6 >= 2_000 else f"r{i // 6}"
        assert got[n] == (rule, pattern, ("block" if i % 2 else "allow") if rule else "block" if pattern else "allow")
    assert [got[len(urls) - j][2] for j in (3, 2, 1)] == ["allow", "allow", "block"]


def test_toxicity_scores_are_averages_of_words():
    """Brute force, word by word: n-grams of each, the mean of their values, the highest mean of 16 words."""
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(0, 3, 512).astype(np.float32), -1.0, 16)
    word = lambda: "".join(random.Random(int(rng.integers(1 << 30))).choices("abcdé", k=int(rng.integers(1, 9))))
    values = toxicity.WordValues(model)
    for n in (0, 1, 3, 4, 15, 16, 17, 24, 25, 100):
        words = [word().encode() for _ in range(n)]
        own = [float(np.mean(model.logits[toxicity.subwords([w], 512)[0]].astype(float))) for w in words]
        means = [np.mean(own[a : a + 16]) for a in ([0] if n <= 16 else [min(a, n - 16) for a in range(0, n - 8, 8)])] if n else [0.0]
        score = toxicity._score(values.of([words])[0], 16, -1.0)
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(max(means) - 1.0, -30, 30))))
    one = toxicity.Model(np.full(4, 6, np.float32), -3.0, 16)
    scores = [toxicity._score(toxicity.WordValues(one).of([[b"word%d" % i for i in range(n)]])[0], 16, -3.0) for n in (4, 16)]
    assert scores[0] == pytest.approx(scores[1])  # a short text is no cleaner for its length
    buckets = toxicity.subwords([b"x" * 50, b"x" * 49 + b"y"], 1 << 17)
    assert len(set(buckets[0][: buckets[1][0]]) & set(buckets[0][buckets[1][0] :])) >= 4  # long words share their n-grams


def test_votes_are_those_of_the_nearest():
    rng = np.random.default_rng(3)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    model = quality_knn.Neighbours(8, np.ones(8), np.eye(8), unit(rng.normal(size=(60, 8))), rng.integers(0, 2, 60).astype(float), 7)
    x = unit(rng.normal(size=(20, 8)))
    for row, vote in zip(x, model.vote(x)):
        near = sorted(range(60), key=lambda i: -float(row @ model.vectors[i]))[:7]
        weight = [max(float(row @ model.vectors[i]), 1e-6) ** 8 for i in near]
        assert vote == pytest.approx(sum(w * model.labels[i] for w, i in zip(weight, near)) / sum(weight), rel=1e-4)
    assert quality_knn.shape(b"aB1-" * 9) != quality_knn.shape(b"aB1-" * 8)


def test_classifiers_hold_out(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choices(["an", "the", "or", "ti", "es"], k=3)) for _ in range(80)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(plain, k=60)
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            words[rng.randrange(60)] = "idiot" + rng.choice(["", "s", "ic", "o"])
        if bad:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (1001, ""), (None, "an or"), (1002, "word " * 40_000)]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, apply, label, at in ((toxicity, toxicity.toxicity, "toxic", 0.5), (quality_knn, quality_knn.quality, "quality", 0.3)):
        model = module.train(docs, lab)
        scored = {r["doc_id"]: r["score"] for r in apply(docs, model).collect()}
        assert len(scored) == 404 and all(0 <= s <= 1 for s in scored.values())
        truth = {i: (q, t)[label == "toxic"] for i, q, t in labels}
        test = [r["doc_id"] for r in docs.where(held_out()).collect() if r["doc_id"] in truth]
        assert np.mean([(scored[i] >= at) == bool(truth[i]) for i in test]) > 0.9
        assert module.train(docs, lab.limit(0)) is not None
        assert apply(docs, module.train(docs, lab.limit(0))).count() == 405
        assert apply(docs.limit(0), model).count() == 0 and module.train(docs.limit(0), lab) is not None
        extra = apply(docs.selectExpr("doc_id", "text", "'own' as score_in", "1 as _text"), model, keep=("doc_id", "score_in", "_text"))
        assert extra.columns == ["doc_id", "score_in", "_text", "score"] and extra.where("score_in = 'own' and _text = 1").count() == 405
        assert apply(docs.where("doc_id = 1001"), model).select("score").distinct().count() == 1
        if label == "toxic":  # a misspelling that training did not see
            unseen = spark.createDataFrame([(1, "ante tior esan idiotx ante"), (2, " ".join(plain[:5]))], "doc_id long, text string")
            unseen_scores = {r["doc_id"]: r["score"] for r in apply(unseen, model).collect()}
            assert unseen_scores[1] >= 0.5 > unseen_scores[2]
    assert [r["h"] for r in docs.where("doc_id is not null").orderBy("doc_id").limit(9).select(held_out().alias("h")).collect()] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(9)]


def test_pipeline_keeps_columns_and_drops(spark, tmp_path, texts):
    import corpus_pipeline

    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    toxic = [(200 + i, f"{texts[20 + i % 20]} {'vileword' * (i % 2)} {i}", i % 2) for i in range(80)]
    texts = [*texts, *[""] * (200 - len(texts)), *[t for _, t, _ in toxic]]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in toxic], "doc_id long, text string, lang string, source string, n_chars long").write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in toxic], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    leaked = next(i for i, t in enumerate(texts) if 40 < len((t or "").split()) < 90 and i > 30)
    spark.createDataFrame([(0, texts[leaked])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        assert docs.count() <= before.count()
        if name == "toxicity":
            here = {r["doc_id"] for r in docs.collect()}
            assert {i for i, _, y in toxic if y}.isdisjoint(here) and {i for i, _, y in toxic if not y} <= here
    kept = {r["doc_id"] for r in docs.collect()}
    assert leaked not in kept and kept <= here
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == kept
    there = set(Path(common.shared_folder(spark)).glob("*"))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    left = set(Path(common.shared_folder(spark)).glob("*")) - there
    assert [x.name.rpartition("-")[0] for x in left] == ["stage-packing"]
    assert Counter((r["doc_id"], r["length"]) for r in whole.collect()) == Counter((r["doc_id"], r["length"]) for r in pieces)
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_judges_rows_not_ids(spark):
    import corpus_pipeline

    rng = random.Random(12)
    make = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    a, b, c, d, line = make(60), make(60), make(60), make(60), make(25)
    rows = [(1, a), (1, a), (2, b), (2, a + " tail"), (None, c), (None, c), (None, b), (3, d + " " + line), (3, make(40) + " " + line), (None, make(40) + " " + line), (4, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    once = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    kept = Counter((r["doc_id"], r["text"]) for r in once.collect())
    assert kept == Counter([(1, a), (2, b), (None, c), *rows[7:]])
    cut = corpus_pipeline.drop_repeated_passages(spark, once, "").collect()
    assert len(cut) == 8 and sum(line in (r["text"] or "") for r in cut) == 1
    assert next(r["doc_id"] for r in cut if line in (r["text"] or "")) == 3
