"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from marketbars.llm import (
    exact_dedup,
    html_extract,
    license_scan,
    mixing,
    packing,
    quality,
    sharding,
    simhash_dedup,
    topk_search,
    toxicity,
)
from marketbars.llm.common import components, ranked

LONG = "word " * 60_000


def rows(frame, *columns):
    picked = [tuple(r[c] for c in columns) for r in frame.collect()]
    return sorted(picked, key=lambda r: [(v is None, 0 if v is None else v) for v in r])


def test_ranks_are_gapless_and_in_order(spark):
    frame = spark.range(1000).selectExpr("id % 7 as a", "id as b", "1 as _id").drop("_id")
    got = {(r.a, r.b): r["rank"] for r in ranked(frame, frame.a, frame.b).collect()}
    assert [got[k] for k in sorted(got)] == list(range(1000))
    assert ranked(frame.limit(0), frame.a, frame.b).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    links = spark.createDataFrame(
        [*chain, *star, (3, 3), (9, 8), (8, 9), (None, 4)], "a long, b long"
    )
    got = dict(rows(components(links), "id", "root"))
    expected = {k: 100 for k in range(100, 161)} | {k: 7 for k in (7, *range(200, 260))}
    assert got == expected | {8: 8, 9: 8}


def test_exact_groups(make_docs):
    docs = make_docs(
        (5, "a  b"), (3, "a\tb"), (3, "a b"), (9, None), (8, ""), (None, "n"), (None, "n"),
        (None, "a b"), (4, " a b"), (1, LONG), (2, LONG + " "),
    )
    got = rows(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept")
    assert got == [
        (1, 1, 2, True), (2, 1, 2, False), (3, 3, 4, True), (3, 3, 4, True), (4, 4, 1, True),
        (5, 3, 4, False), (8, 8, 2, True), (9, 8, 2, False), (None, 3, 4, False),
        (None, None, 2, True), (None, None, 2, True),
    ]
    sha = {r.doc_id: r.text_sha256 for r in exact_dedup.exact_groups(docs).collect()}
    assert sha[5] == hashlib.sha256(b"a b").hexdigest()
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert rows(left, "doc_id") == [(1,), (3,), (4,), (8,), (None,)]
    assert exact_dedup.exact_groups(docs.limit(0)).collect() == []
    assert exact_dedup.drop_copies(docs.limit(0)).collect() == []


def test_exact_groups_sort_by_content_without_hashing_texts(make_docs):
    plan = exact_dedup.text_runs(make_docs((1, "a")))._jdf.queryExecution().toString()
    assert "SortAggregate" in plan and "rangepartitioning" in plan.lower()


def test_a_large_group_of_copies_is_cut(spark, make_docs):
    docs = spark.range(5000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'same', cast(id as string)) as text"
    )
    runs = exact_dedup.text_runs(docs)
    sizes = Counter(r.group_size for r in runs.collect())
    assert sizes[1667] == exact_dedup.SALTS
    assert exact_dedup.exact_groups(docs).where("kept").count() == 5000 - 1666


def test_near_groups(make_docs):
    text = " ".join(f"w{k}" for k in range(400))
    docs = make_docs(
        (9, text), (2, text.upper().replace("W", "w")), (2, text), (7, None), (6, " \n"),
        (None, text), (5, "one two"), (4, "ONE two"), (1, LONG),
    )
    got = rows(simhash_dedup.near_groups(docs), "doc_id", "component_id")
    assert got == [(1, 1), (2, 2), (2, 2), (4, 4), (5, 4), (6, 6), (7, 6), (9, 2), (None, 2)]
    prints = dict(rows(simhash_dedup.near_groups(docs), "doc_id", "fingerprint"))
    assert prints[7] == "0" * 16
    left = simhash_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert rows(left, "doc_id") == [(1,), (2,), (2,), (4,), (6,), (None,)]
    assert simhash_dedup.near_groups(docs.limit(0)).collect() == []


def test_no_link_is_lost_in_dense_groups(spark):
    """Chains of few differing bits, dense clouds and strangers, against all pairs."""
    draw = np.random.default_rng(1)
    prints = set(int(v) for v in draw.integers(0, 1 << 63, 60))
    for _ in range(6):
        base = int(draw.integers(0, 1 << 63))
        for _ in range(40):
            bits = draw.choice(63, int(draw.integers(0, 6)), replace=False)
            prints.add(base ^ sum(1 << int(b) for b in bits))
        step = base
        for b in draw.permutation(63)[:30]:
            step ^= 1 << int(b)
            prints.add(step)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r.fp: r.root for r in simhash_dedup.fingerprint_roots(frame).collect()}
    ids, group = sorted(prints), {}
    for p in ids:
        near = {group[q] for q in group if (p ^ q).bit_count() <= 4}
        group[p] = p
        for q in group:
            if group[q] in near:
                group[q] = p
    ours, theirs = {}, {}
    for p in ids:
        ours.setdefault(got.get(p, p), set()).add(p)
        theirs.setdefault(group[p], set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_pivot_distances_bound_the_distance():
    pivots = [p % (1 << 64) for p in simhash_dedup.pivot_values()]
    draw = np.random.default_rng(2)
    for _ in range(200):
        a = int(draw.integers(0, 1 << 63))
        b = a ^ sum(1 << int(k) for k in draw.choice(64, 4, replace=False))
        assert max(abs((a ^ p).bit_count() - (b ^ p).bit_count()) for p in pivots) <= 4
        masks = [m % (1 << 64) for m in simhash_dedup.block_masks()]
        assert any(a & m == b & m for m in masks)


def test_mix(make_docs):
    some = [(k, "w " * (k % 40 + 1 + k % 3), ("a", "b", None)[k % 3]) for k in range(3000)]
    docs = make_docs(*some, (5000, None, "a"), (None, "x y", "b"), (7, "w " * 8, "b"), (9, LONG, "c"))
    got = mixing.mix(docs).collect()
    assert len(got) == 3004
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    of = {}
    for r in got:
        of.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), part in of.items():
        assert sum(r.size for r in part) == size
        assert abs(sum(r.taken for r in part) - target) <= max(0.002 * target, LONG.count(" ") / 2 * (size == 60_000))
    assert sum(t for _, t in of) == pytest.approx(1.5 * sum(r.size for r in got))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixing.mix(docs.limit(0)).collect() == []
    assert mixing.mixed_documents(docs.limit(0)).collect() == []


def test_small_documents_make_up_for_a_large_one(make_docs):
    """Without them, the large document's rounding alone would miss by up to half of it."""
    docs = make_docs(
        *((k, "w " * (k % 50 + 10), "a") for k in range(300)), (999, "w " * 5000, "a"),
        *((2000 + k, "w " * 500, "b") for k in range(40)),
    )
    got = mixing.mix(docs).collect()
    for source in {r.source_size for r in got}:
        part = [r for r in got if r.source_size == source]
        assert abs(sum(r.taken for r in part) - part[0].target) <= (250 if source == 20_000 else 30)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in part)


def test_rows_of_one_id_are_mixed_each(make_docs):
    rows = [(None, f"a {k} c", "s") for k in range(400)] + [(7, f"a {k} c d", "t") for k in range(400)]
    docs = make_docs(*rows)
    copies = Counter(r.text for r in mixing.mixed_documents(docs).collect())
    shares = mixing.mix(docs).collect()
    assert sum(copies.values()) == sum(r.copies for r in shares)
    for size, kind in ((3, 1200), (4, 1600)):
        words = sum(n * size for text, n in copies.items() if len(text.split()) == size)
        target = next(r.target for r in shares if r.source_size == kind)
        assert abs(words - target) <= size


def test_toxicity(spark, make_docs, make_labels):
    bad = [(k, f"Fine words here. You total grumpf{k % 3} person! More fine words.") for k in range(60)]
    good = [(k, f"Fine words here. A nice day {k}! More fine words.") for k in range(60, 240)]
    odd = [(300, None), (301, ""), (None, "You total grumpf1 person"), (302, LONG), (303, "!!! ...")]
    docs = make_docs(*bad, *good, *odd, bad[0])
    labels = make_labels(*((k, 1, int(k < 60)) for k in range(240)), (1, 0, None), (None, 1, 1))
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all(got[k].predicted == 1 for k in range(60))
    assert not any(got[k].predicted for k in range(60, 240))
    assert (got[300].score, got[301].score, got[303].score) == (0, 0, 0)
    found = toxicity.offending_sentences(docs, model).where("doc_id = 4").collect()
    assert [r.sentence for r in found] == [" You total grumpf1 person"]
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == 180 + 4
    assert toxicity.score_documents(docs.limit(0), model).collect() == []
    none = toxicity.fit(docs.limit(0), labels.limit(0))
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs, none).collect())


def test_long_clean_documents_stay(spark, make_docs, make_labels):
    """Toxic labels without a tied feature must not add up over the sentences of a clean text."""
    bad = [(k, f"Fine words here. You total grumpf{k % 3} person!") for k in range(60)]
    odd = [(k, f"Fine words here. A nice day {k}!") for k in range(60, 70)]
    good = [(k, f"Fine words here. A nice day {k}!") for k in range(70, 400)]
    long = "Fine words here on a nice day. " * 10_000
    docs = make_docs(*bad, *odd, *good, (500, long), (501, long + "You total grumpf1 person!"))
    labels = make_labels(*((k, 1, int(k < 70)) for k in range(400)))
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert scores[500].score == pytest.approx(scores[70].score) and not scores[500].predicted
    assert all(scores[k].predicted for k in (*range(60), 501))
    left = rows(toxicity.drop_toxic(docs, model), "doc_id")
    assert left == [(k,) for k in (*range(60, 400), 500)]


def test_held_out_labels_are_not_learnt(make_docs, make_labels):
    docs = make_docs(*((k, f"grumpf text {k}") for k in range(400)))
    labels = make_labels(*((k, 1, 1) for k in range(400)))
    sample = toxicity.training_sample(docs, labels)
    kept_out = toxicity.score_documents(docs, toxicity.Model(-1.0, {})).where("held_out").count()
    assert 0 < kept_out and sample.count() == 400 - kept_out


def test_quality(make_docs, make_labels):
    clean = " ".join(f"plain{k} text" for k in range(30))
    docs = make_docs(
        *((k, f"{clean} {k}" if k % 2 else "%%% ||| $$$ " * 20, f"s{k % 3}") for k in range(300)),
        (900, None, None), (901, "", "new"), (None, clean, "s1"), (902, LONG, "s2"),
    )
    labels = make_labels(*((k, k % 2, 0) for k in range(300)), (None, 1, 0), (3, None, 0))
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert len(got) == 304 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[k].kept == bool(k % 2) for k in range(300))
    assert quality.score(docs.limit(0), labels).collect() == []
    assert quality.score(docs, labels.limit(0)).count() == 304


def test_sparse_sites_shrink_to_their_prior(spark):
    many = [("big", "p", int(k % 10 > 0)) for k in range(1000)]
    poor = [("poor", "p", int(k % 10 == 0)) for k in range(1000)]
    frame = spark.createDataFrame(
        [*many, *poor, ("big", "one", 0), ("tiny", "p", 0)], "host string, path string, good int"
    )
    hosts, paths, overall = quality.site_posteriors(frame)
    host = dict(rows(hosts, "_host", "host_quality"))
    path = {(r._path_host, r._path): r.path_quality for r in paths.collect()}
    assert host["big"] > 0.85 and host["poor"] < 0.15 and 0.1 < host["tiny"] < overall
    assert path[("big", "one")] > 0.5


def test_packing(make_docs):
    docs = make_docs((1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x"), (4, LONG))
    got = packing.pack(docs)
    lengths = Counter(r.length for r in got.collect())
    assert lengths == Counter({2048: 29, 609: 1, 4: 2, 1: 2, 2: 1})
    places = sorted((r.sequence_id, r.offset, r.length) for r in got.collect())
    assert len({s for s, _, _ in places}) == 30 and len(set(places)) == 35
    assert packing.pack(docs.limit(0)).collect() == []


def test_words_of_every_kind_are_the_tokenizers():
    from tokenizers import Tokenizer

    vocabulary = packing.default_vocabulary()
    encode, tokenizer = packing.text_encoder(vocabulary), Tokenizer.from_file(vocabulary)
    odd = [
        "It's don't WE'LL 'S", "<|endoftext|> a<|endoftext|>b <|x", "ΣΑΣ ΟΔΟΣ.", "á é",
        "x y\x1cz\x85q", "İstanbul ǅ ﬁ", "100,5% a1b2", "über-ÄÖÜß ñ×÷", "日本 語", "\x0b\x0c",
        "_a_ __ ​", "naïve’s",
    ]
    for text in odd:
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 0], text


def test_plan_places_every_piece_once_and_tightly():
    draw = np.random.default_rng(3)
    for size, n in ((10, 300), (64, 2000), (2048, 5000)):
        counts = Counter(int(v) for v in draw.integers(1, size + 1, n))
        used, ranks = {}, Counter()
        matches = packing.plan(dict(counts), size)
        for length in counts:
            own = sorted(m for m in matches if m[0] == length)
            ends = [m[1] for m in own[1:]] + [counts[length]]
            for (_, start, first, each, base), end in zip(own, ends):
                for i in range(end - start):
                    ranks[length, start + i] += 1
                    at = base + i % each * length
                    used.setdefault(first + i // each, []).append((at, length))
        assert len(ranks) == n and set(ranks.values()) == {1}
        for placed in used.values():
            end = 0
            for at, length in sorted(placed):
                assert at == end
                end += length
            assert end <= size
        total = sum(k * v for k, v in counts.items())
        assert len(used) <= 1.25 * -(-total // size)


def test_shards(spark, make_docs, tmp_path):
    docs = make_docs(
        *((k, "x" * (k % 50)) for k in range(2000)), (None, "n"), (None, None), (5, "x" * 5)
    )
    got = sharding.shard(docs).collect()
    assert len(got) == 2003
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) < 0.05 * sum(loads.values()) / 16
    assert sharding.shard(docs.limit(0)).collect() == []


def test_rebalancing_edits_few_slots(spark, tmp_path):
    draw = np.random.default_rng(4)
    sizes = {k: int(v) for k, v in enumerate(draw.integers(1, 1000, sharding.SLOTS))}
    one = sharding.rebalanced({}, sizes, 16)
    two = sharding.rebalanced(one, sizes, 17)
    moved = [k for k in one if one[k] != two[k]]
    assert len(moved) < sharding.SLOTS / 8
    for slots, shards in ((one, 16), (two, 17)):
        order = range(sharding.SLOTS)
        loads = np.bincount([slots[k] for k in order], [sizes[k] for k in order], shards)
        assert loads.max() - loads.min() <= 0.01 * loads.mean()
    path = str(tmp_path / "map")
    sharding.store_map(spark, path, one, 1)
    sharding.store_map(spark, path, two, 2)
    assert dict(rows(sharding.load_map(spark, path, 1), "virtual_slot", "shard")) == one
    assert dict(rows(sharding.load_map(spark, path), "virtual_slot", "shard")) == two


def test_top_k(spark):
    vectors = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, [0.5, 0.25]), (4, None),
        (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (9, [2.0]),
        (None, [9.0, 9.0]), (1, [0.5, 0.5]), (50, [-1.0, 0.0]),
    ]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = rows(topk_search.top_k(frame), "query_id", "rank", "vec_id", "score")
    assert got[:5] == [
        (0, 1, 9, 131072), (0, 2, 1, 32768), (0, 3, 1, 32768), (0, 4, 2, 32768), (0, 5, 3, 32768),
    ]
    assert [g[2] for g in got[5:]] == [8, 1, 1, 2, 3]
    assert topk_search.top_k(frame.limit(0)).collect() == []


def test_ball_tree_search_is_exact():
    draw = np.random.default_rng(5)
    points = np.floor(draw.normal(size=(3000, 12)) * 256)
    points[1000:1100] = points[0]
    tree, ids = topk_search.BallTree(points), np.arange(3000)
    for own in range(0, 3000, 300):
        query = points[own]
        most = tree.bounds(query[None])[0]
        got = sorted(topk_search.search(tree, ids, query, own, most, 5, topk_search.NONE),
                     key=lambda r: (-r[0], r[1]))
        scores = (points @ query).astype(int)
        expected = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != own)[:5]
        assert got == [(-s, i) for s, i in expected]


def page(body, head="<title>t</title>"):
    return f"<html><head>{head}</head><body>{body}</body></html>"


def test_pages_with_and_without_landmarks(spark):
    chrome = (
        '<header><h1>Site</h1></header><nav><a href="/">Home</a></nav>'
        '<div class="content with-sidebar"><div id="post">{}</div><div class="sidebar">side</div></div>'
        '<div class="comment-list"><p>reader says</p></div><form><p>Search</p></form>'
        '<div class="cookie-notice">cookies</div><footer>&copy; all</footer>'
    )
    plain = [
        (k, f"http://plain.org/{k}", page(chrome.format(
            f"<h2>Title {k}</h2><p>First&nbsp;{k} &lt;b&gt;  text<br>more<p>Second {k}</p>"
            "<p>Printed on every page</p><script>if (a<b) '</p>'</script>")))
        for k in range(30)
    ]
    named = [
        (100 + k, "https://news.org/a", page(
            f"<p>outside</p><article><p>In {k}<aside>no</aside><ul><li>x<li>y</ul></article>"))
        for k in range(3)
    ]
    odd = [
        (200, None, None), (201, "", ""), (202, "x", "just text & more"), (203, None, "<p>cut <b"),
        (None, "http://one.org", page("<main><p>only</main>")), (0, *plain[0][1:]),
        (204, "http://long.org", page(f"<article><p>{LONG}</p></article>")),
    ]
    frame = spark.createDataFrame(
        [(*r, "clash") for r in [*plain, *named, *odd]],
        "page_id long, url string, html string, host string",
    )
    found = html_extract.main_texts(frame).collect()
    assert len(found) == 40
    got = {r.page_id: r.text for r in found}
    for k in range(30):
        shared = "Printed on every page"  # inside the article, so it is part of it
        assert got[k] == f"Title {k}\n\nFirst {k} <b> text more\n\nSecond {k}\n\n{shared}"
    for k in range(3):
        assert got[100 + k] == f"In {k}\n\nx\n\ny"
    assert (got[200], got[201], got[202], got[203]) == ("", "", "just text & more", "cut")
    assert got[None] == "only" and got[204] == LONG.strip()
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_extract.main_texts(frame.limit(0)).collect() == []


def test_articles_that_all_pages_of_a_host_share_stay(spark):
    """Repeated pages and near copies give the text that one page alone gives."""
    post = "<h1>Head</h1><p>One paragraph</p><div><p>Another</p></div>"
    shared = "<article><h1>Same head</h1><p>Own {}</p><p>Same end</p></article>"
    frame = spark.createDataFrame(
        [
            *((k, f"http://named.org/{k}", page(f"<article>{post}</article>")) for k in range(25)),
            *((100, "http://row.org/a", page(f"<div>{post}</div>")) for k in range(25)),
            *((200 + k, f"http://near.org/{k}", page(f"<div>{post}<p>{k}</p></div>")) for k in range(25)),
            *((300 + k, f"http://shared.org/{k}", page(shared.format(k))) for k in range(25)),
        ],
        "page_id long, url string, html string",
    )
    whole = "Head\n\nOne paragraph\n\nAnother"
    expected = [*((k, whole) for k in range(25)), *[(100, whole)] * 25]
    expected += [(200 + k, f"{whole}\n\n{k}") for k in range(25)]
    expected += [(300 + k, f"Same head\n\nOwn {k}\n\nSame end") for k in range(25)]
    assert rows(html_extract.main_texts(frame), "page_id", "text") == expected


def test_text_beside_the_largest_block_stays(spark):
    menu = '<div class="top"><a href="/a">One</a> | <a href="/b">Two</a></div>'
    blocks = (
        '<div class="page"><h1>Head {0}</h1><div class="lead">Lead {0}, see <a href="/">this</a></div>'
        '<div class="text"><p>{1}</p><p>More {0}</p></div><div class="end">End {0}</div></div>'
    )
    long = "many words of an article " * 20
    frame = spark.createDataFrame(
        [
            *((k, f"http://body.org/{k}", page(menu + blocks.format(k, long))) for k in range(5)),
            *((10 + k, f"http://bare.org/{k}", menu + f"<h1>Head {k}</h1><div>{long}</div>") for k in range(5)),
        ],
        "page_id long, url string, html string",
    )
    got = dict(rows(html_extract.main_texts(frame), "page_id", "text"))
    for k in range(5):
        parts = [f"Head {k}", f"Lead {k}, see this", long.strip(), f"More {k}", f"End {k}"]
        assert got[k] == "\n\n".join(parts)
        assert got[10 + k] == "\n\n".join(["One | Two", f"Head {k}", long.strip()])


def test_licenses(spark, make_docs):
    apache = license_scan.NOTICES["Apache-2.0"]
    docs = make_docs(
        (1, f"x y {apache} z"), (2, None), (3, "four words are few"), (4, f"{LONG}\n{apache}"),
        (None, apache.upper()), (1, f"x y {apache} z"), (5, (apache + " ") * 3),
        (6, "licensed under the apache license version 1 1"), (7, "a " * 40 + apache + " b" * 40),
    )
    templates = license_scan.notices(spark)
    got = rows(license_scan.scan(docs, templates), "doc_id", "license", "containment",
               "first_word", "last_word")
    assert got == [
        (1, "Apache-2.0", 1.0, 2, 9), (4, "Apache-2.0", 1.0, 60000, 60007),
        (5, "Apache-2.0", 1.0, 0, 23), (7, "Apache-2.0", 1.0, 40, 47),
        (None, "Apache-2.0", 1.0, 0, 7),
    ]
    assert license_scan.scan(docs.limit(0), templates).collect() == []
    assert license_scan.scan(docs, templates.limit(0)).collect() == []
