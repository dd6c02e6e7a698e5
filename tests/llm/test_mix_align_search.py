"""Mixing, alignment and search on small tables and against brute force."""

import collections
import hashlib
import itertools
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from hourmart.llm import alignment, mixing, queries, search
from hourmart.llm.common import ship
from hourmart.llm.queries import tokenizer

WORDS = ["the", "of", "and", "ering", "thion", "était", "straße", "año", "x1", "Long", "WORD", "don't", "a--b", "漢字", "<s>",
         "<|endoftext|>", "12345", "ﬁn", "é", "<0x41>", "|,;"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    out = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 5, 30, 200]))) for _ in range(60)]
    out += ["", None, " ", "  two  blanks ", "line\nfeed \n x", "tab\tand nbsp", "a▁b", "\x00\x1f", "end ", out[7], out[7]]
    return out + [" ".join(rng.choice(WORDS) for _ in range(20_000))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, f"s{i % 5}" if i % 7 else None, "clash", "clash") for i, t in enumerate(texts)]
    rows += [(None, texts[3], "s1", None, None), (3, texts[3], "s3", "clash", "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, row string").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# --- mixing ---

def _targets(sizes, weights, most=3):
    total, fixed = sum(sizes.values()), {}
    while True:
        w = {s: weights[s] for s in sizes if s not in fixed}
        share = {s: Fraction((total - sum(fixed.values())) * w[s], sum(w.values())) for s in w}
        above = {s: most * sizes[s] for s in w if share[s] > most * sizes[s]}
        if not above:
            return {**fixed, **share}
        fixed |= above


def test_mix_meets_its_targets(docs, texts):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert len(rows) == len(texts) + 2 and rows[0].row == "clash"  # other columns stay, clashing ones are replaced
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.taken == r.passes * r.size and r.passes <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = _targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
    for s in sizes:  # whole documents: within half the longest one
        longest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - float(want[s])) <= longest / 2 + 1, s
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_shares_what_small_sources_cannot_take(spark):
    rows = [(i, " ".join(["w"] * 10), "a" if i < 3 else "b" if i < 50 else "c") for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = {r.source: r.target for r in got}
    assert target == {"a": 90.0, "b": 1410.0, "c": 2500.0}
    assert {r.passes for r in got if r.source == "a"} == {3}


def test_one_length_and_repeated_rows_are_cut_exactly(spark):
    # equal rows tie on the hash; cells of 7 rows make many cells of one length
    rows = [(i % 90, "one two three four", "a") for i in range(900)] + [(5000 + i, "x " * 9, "b") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(df, cell=7).collect()
    for s in ("a", "b"):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= mine[0].size


def test_knapsack_finds_the_nearest_sum():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 7)
        length = np.array(rng.sample(range(1, 40), n))
        count = np.array([rng.randrange(0, 5) for _ in range(n)])
        budget = rng.randrange(0, 150)
        take = mixing.reach(length, count, budget)
        assert (take >= 0).all() and (take <= count).all()
        sums = {sum(k * int(x) for k, x in zip(ks, length)) for ks in itertools.product(*[range(int(c) + 1) for c in count])}
        near = min(abs(budget - s) for s in sums if s <= budget + length.max())
        assert abs(budget - int((take * length).sum())) == near
        whole = mixing.fit(length, count, min(budget, int((length * count).sum())))
        assert (whole >= 0).all() and (whole <= count).all()


# --- alignment ---

def _plain_tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(_plain_tokens, "models"):
        a = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
        a.encode_special_tokens = True
        _plain_tokens.models = a, sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    a, b = _plain_tokens.models
    if not text:
        return [], []
    level = alignment.byte_level_table()
    ta = [(i, bytes(level[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    tb = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (ta, tb) if b"".join(x for _, x in ta) == whole == b"".join(x for _, x in tb) else ([], [])


def _plain_alignment(text):
    ta, tb = _plain_tokens(text)
    spans = []
    for side in (ta, tb):
        at, out = 0, []
        for i, raw in side:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        spans.append(out)
    links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]] if len(ta) < 2000 else None
    if links is None:  # the same by sweeping, for long texts
        links, j = [], 0
        for x in spans[0]:
            while spans[1][j][2] <= x[1]:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < x[2]:
                links.append((x[0], spans[1][k][0]))
                k += 1
    cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
    groups, lo = [], 0
    ia = ib = 0
    for hi in cuts:
        part = []
        for side, at in ((spans[0], ia), (spans[1], ib)):
            end = at
            while end < len(side) and side[end][2] <= hi:
                end += 1
            part.append((",".join(str(t[0]) for t in side[at:end]), end))
        groups.append(part[0][0] + "|" + part[1][0])
        ia, ib, lo = part[0][1], part[1][1], hi
    return len(ta), len(tb), len(cuts), links, ";".join(groups)


def test_alignment_against_plain_overlaps(docs, texts, none, monkeypatch):
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    plain = [_plain_alignment(t) for t in texts]
    count = collections.Counter(p for t in [*plain, plain[3], plain[3]] for p in t[3])
    most = collections.Counter()
    for (a, b), c in count.items():
        most[b] = max(most[b], c)
    for hot in (10 ** 6, 40):  # all pair counts broadcast, and most of them joined
        rows = alignment.align(docs, *paths, keep_groups=True, hot=hot).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            n_a, n_b, n_groups, links, groups = plain[3 if r.doc_id is None else r.doc_id]
            assert r.groups == groups
            assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, n_groups, len(links))
            assert r.n_best == sum(count[p] == most[p[1]] for p in links)
            assert r.count_sum == sum(count[p] for p in links)
            assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
    assert alignment.align(none, *paths).count() == 0


def test_long_texts_are_jumped_in_runs(texts, monkeypatch):
    import pyarrow as pa

    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    part = pa.array([t for t in texts if t], pa.large_string())
    whole = alignment.Aligner(*paths).chunk(part, True)
    monkeypatch.setattr(alignment, "RUN", 97)
    cut = alignment.Aligner(*paths).chunk(part, True)
    for c in ("n_a", "n_b", "n_groups", "n_links", "digest", "groups"):
        assert list(whole[c]) == list(cut[c]), c
    assert whole["times"].sum() == cut["times"].sum()


def test_pointers_end_at_the_component():
    a, b = np.array([2, 5, 6, 9, 12]), np.array([3, 4, 6, 7, 12])
    assert alignment.farthest_tokens(a, b).tolist() == [7, 7, 7, 9, 9, 7, 7, 7, 9, 9]


# --- search ---

def _plain_search(texts, items, k):
    import math

    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    docs = [(i, collections.Counter(terms(t)), len(terms(t))) for i, t in texts]
    N, L = sum(n > 0 for *_, n in docs), sum(n for *_, n in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, collections.Counter()).update(terms(t))
    out = []
    for item, q in asked.items():
        found = []
        for i, c, n in docs:
            if n:
                m = 100 - 25 + (25 * n * N) // L
                s = sum(times * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) *
                        ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in q.items())
                if s > 0:
                    found.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def test_search_against_scoring_everything(docs, texts, none, spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(8))) for i in range(12)]
    items += [(12, texts[4]), (12, "été the the"), (13, None), (14, ""), (15, "no such terms"), (None, texts[5]), (16, "The THE the")]
    asked = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, score string")
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (3, texts[3])]
    for k, block, first in ((5, 10 ** 6, 1 / 32), (20, 30, 0.5)):  # one block of items, and several
        want = _plain_search(rows, items, k)
        got = search.ranked_search(docs, asked, k=k, block_entries=block, first_part=first).collect()
        assert sorted([tuple(r) for r in got], key=str) == want
    assert search.ranked_search(none, asked).count() == 0
    assert search.ranked_search(docs, asked.limit(0)).count() == 0


def test_buckets_prune_and_lose_nothing(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    n_terms, n_docs, n_items, k = 50, 3000, 9, 4
    weight = rng.integers(1, 9000, n_terms)
    row, term = np.nonzero(rng.random((n_docs, n_terms)) < 0.1)
    x = rng.integers(1, 10 ** 6, len(row)) // rng.integers(1, 400, n_docs)[row] + 1
    item, t = np.nonzero(rng.random((n_items, n_terms)) < 0.08)
    items = search.Items(item, t, rng.integers(1, 3, len(item)), weight, n_items)
    norm = np.sqrt(np.bincount(row, weight[term] * x.astype(float) ** 2, n_docs))
    order = np.argsort(-norm, kind="stable")
    place = np.empty(n_docs, int)
    place[order] = np.arange(n_docs)
    bounded = []
    real = search.coordinate_bounds
    monkeypatch.setattr(search, "coordinate_bounds", lambda *a: bounded.append(real(*a)) or real(*a))
    best = [search.Best(k, 0) for _ in range(n_items)]
    seen = 0
    for at in range(0, n_docs, 100):
        mine = (place[row] >= at) & (place[row] < at + 100)
        before = len(bounded)
        search.search_bucket(items, best, pa.array(order[at:at + 100]), norm[order[at:at + 100]], term[mine],
                             place[row][mine] - at, x[mine])
        seen += len(bounded) - before
    assert seen < n_items * (n_docs // 100)  # whole buckets were pruned
    assert any((low > 0).any() for low, _ in bounded)  # and coordinates bounded
    dense = np.zeros((n_docs, n_terms), np.int64)
    dense[row, term] = x
    for i, b in enumerate(best):
        q = np.zeros(n_terms, np.int64)
        q[items.term[items.end[i]:items.end[i + 1]]] = items.q[items.end[i]:items.end[i + 1]]
        score = dense @ q
        want = sorted(((-s, d) for d, s in enumerate(score) if s > 0))[:k]
        assert [(-s, d) for s, d in zip(b.score.tolist(), b.id.to_pylist())] == want


def test_queries_read_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for q in (queries.op11_mixing, queries.op12_alignment):
        assert q(spark, sf).count() == n
