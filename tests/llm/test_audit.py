"""Collocations, source divergence and chat formatting against brute force, with nulls, empties, ties and clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pricepanel.llm import chat_format, collocations, divergence, queries

DOCS = "doc_id long, text string, lang string, source string, phrase string, n string, term string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdeFéß", k=rng.randint(1, 3))) for _ in range(60)]
    out = []
    for i in range(260):
        said = rng.choices(words, k=rng.randint(0, 40), weights=range(60, 0, -1))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "\r", "-", " ", "2"]) for w in said)
        if i % 4 == 0:
            text += rng.choice([" New York City hall", " new york city", "NEW York! City"])
        out.append((i, None if i % 50 == 7 else text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "", None, "é"])))
    long = " ".join(rng.choices(words, k=3000))
    out += [(900, long, "en", "long"), (901, long, "en", "long"), (901, long, "en", "long"), (902, "...", "xx", "only"), (903, None, "xx", "none"), (904, "solo word", "yy", "s")]
    return [(*r, "own", "own", "own") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


def phrases_by_hand(rows, least=10, top=2000):
    f = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, n in f.items():
        found = []
        for w, a in n.items():
            if len(w) == 1 or a < least:
                continue
            if len(w) == 2 and any(len(v) == 3 and w in (v[:2], v[1:]) and m >= least and 100 * m >= 50 * a for v, m in n.items()):
                continue
            score, cut = min((1_000_000 * a * a // (n[w[:k]] * n[w[k:]]), k) for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), n[w[:cut]], n[w[cut:]]))
        total = sum(v for w, v in n.items() if len(w) == 1)
        out += [(lang, i, p.decode(), -a, left, right, total, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("settings", [{}, {"ranked_words": 9, "ranked_pairs": 5}, {"ranked_words": 60, "ranked_pairs": 12, "fan_in": 1, "most": 30}, {"top": 4}])
def test_collocations(docs, rows, settings):
    got = sorted(map(tuple, collocations.collocations(docs, **settings).collect()))
    want = phrases_by_hand(rows, top=settings.get("top", 2000))
    assert got == want and len({r[0] for r in want}) == 4
    assert any(len(r[2].split(" ")) == 3 for r in want)


def test_collocations_of_no_rows(spark, docs):
    empty = spark.createDataFrame([], DOCS)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(docs.where("lang = 'xx'")).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(empty, ranked_words=1 << 19)


def test_token_lists_hold_every_run_once():
    rng = random.Random(4)
    for step in (3, 17, 1 << 20):
        for k in (1, 2, 3):
            texts = ["".join(rng.choices("ab. ,\t", k=rng.randint(0, 60))) for _ in range(12)]
            got = Counter(tuple(w[i : i + k]) for w in collocations.token_lists(texts, k, step) for i in range(len(w) - k + 1) if b"." not in w[i : i + k])
            want = Counter(tuple(w[i : i + k]) for t in texts for p in re.split("[.,]", t) for w in [p.encode().split()] for i in range(len(w) - k + 1))
            assert got == want


def test_tiles_count_dense_and_sparse():
    rng = np.random.default_rng(5)
    tiles, seen = collocations.Tiles(pending=1000, most=2000, dense=2, full=300), Counter()
    got = Counter()
    for lang in ["a", "b"] * 6:
        x, y = rng.geometric(0.001, 700), rng.geometric(0.0005, 700)
        seen.update((lang, int(a), int(b)) for a, b in zip(x, y, strict=True))
        full = tiles.add(lang, x, y)
        for la, tile, cells, n in tiles.taken() if full else ():
            got.update({(la, *map(int, collocations.ranks_of(tile << 23 | c))): int(m) for c, m in zip(cells, n, strict=True)})
    for la, tile, cells, n in tiles.taken():
        got.update({(la, *map(int, collocations.ranks_of(tile << 23 | c))): int(m) for c, m in zip(cells, n, strict=True)})
    assert got == seen


def divergence_by_hand(rows, least_docs=10, top=10):
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        g = (lang or "", source or "")
        groups.add(g)
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        n[g].update(terms)
        df[g[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, d in df[lang].items() if d >= least_docs)
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}
        p = {s: share(n[la, s]) for la, s in groups if la == lang}
        whole = Counter()
        for s in p:
            whole.update(n[lang, s])
        q = share(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in p:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in p if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)]
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("settings", [{}, {"most_terms": 3, "tile": 2}, {"tile": 1}])
def test_divergence(docs, rows, settings):
    got = sorted(map(tuple, divergence.audit(docs, **settings).select("lang", "source", "part", "item", "value", "rank").collect()))
    want = divergence_by_hand(rows)
    assert got == want
    assert ("xx", "only", "pair", "none", 0, 1) in want and any(r[2] == "term" for r in want)


def test_divergence_of_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_and_runs_are_exact():
    rng = random.Random(6)
    for _ in range(300):
        v, counts = rng.randint(1, 10**6), [rng.randint(0, 10 ** rng.randint(0, 15)) for _ in range(5)]
        n = sum(counts)
        assert divergence.shares(np.array(counts), n, v).tolist() == [1 + 10**9 * (c + 2) // (n + 2 * v) for c in counts]
        terms = rng.randint(1, 30)
        column = [rng.choice([0, 0, 1, 1, 2]) for _ in range(terms)]
        at = np.flatnonzero(column)
        ends, values = divergence.run_lengths(at, np.array(column)[at], terms)
        assert np.repeat(values, np.diff(ends, prepend=0)).tolist() == column and (values[1:] != values[:-1]).all()
    with pytest.raises(OverflowError):
        divergence.shares(np.array([1]), 10**16, 1)


def conversations():
    rng = random.Random(7)
    bits = ["a", "é", "\n", "<|im_end|>", "<|im_end|>\n", "</s>", "[INST]", "[/INST]", "<\\s>", "\\", "<", "[", "<<SYS>>", "|im_end|>", "[\\\\INST]", "hello ", "日本"]
    out = []
    for i in [*range(40), None]:
        for t in range(400 if i == 7 else rng.randint(1, 9)):
            out.append((i, None if rng.random() < 0.02 else t // 2 if i == 3 else t, rng.choice(["user", "assistant", "sys\\n\ntem\\", "[INST]", None]), None if rng.random() < 0.1 else "".join(rng.choices(bits, k=40_000 if (i, t) == (9, 0) else rng.randint(0, 12))), "own", "own"))
    out += [(50, 0, "assistant", "twice", "", ""), (50, 0, "assistant", "twice", "", ""), (51, 0, "user", "", "", "")]
    rng.shuffle(out)
    return out


def test_chat_formatting(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, piece string, formatted string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")  # many pieces
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chats = chat_format.format_chats(df)
        got = {r["conv_id"]: r for r in chat_format.read_formatted(chats).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert chats.where("conv_id = 7").count() > 2 and len(got) == chats.select("conv_id").distinct().count()
    whole = defaultdict(list)
    for r in chats.orderBy("part", "piece").collect():
        whole[r["conv_id"]].append(r["formatted"])
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x, *_ in rows if c == conv)
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
        text = "".join(whole[conv])
        assert r["formatted_chars"] == len(text)
        # Of the control strings only the marks of the turns are left.
        assert {c: text.count(c) for c in chat_format.CONTROLS if c in text} == {"<|im_start|>": len(turns), "<|im_end|>": len(turns)}


def test_chat_formatting_of_no_rows_and_other_templates(spark):
    schema = "conv_id long, turn int, role string, text string"
    empty = chat_format.format_chats(spark.createDataFrame([], schema))
    assert empty.count() == 0 and chat_format.read_formatted(empty).count() == 0
    for bad in ({"controls": ("<a<",)}, {"start": "turn:"}, {"controls": ("",)}):
        with pytest.raises(ValueError):
            chat_format.Template(**bad)
    other = chat_format.Template(start="{turn}", end="{end}", controls=("{turn}", "{end}"), learnt=("user", "assistant"))
    rows = [(1, 0, "user", "{turn}{\\end}"), (1, 1, "assistant", "x{end}")]
    chats = chat_format.format_chats(spark.createDataFrame(rows, schema), template=other)
    assert chats.first()["formatted"] == "{turn}user\n{\\turn}{\\\\end}{end}{turn}assistant\nx{\\end}{end}"
    assert chat_format.read_formatted(chats, other).first()["loss_chars"] == len("{turn}{\\end}x{end}")
    with pytest.raises(ValueError):
        list(chat_format.Reader(other).turns(b"user\nx{end}"))


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_source_divergence", "op13_chat_formatting"])
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    got = queries.queries()[name](spark, folder)
    with duckdb.connect() as con:
        for t in ("documents", "conversations"):
            con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
        want = con.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.fetchall()) and set(columns) == set(got.columns)
