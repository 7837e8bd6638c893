"""Results against brute force, exact round trips and held-out labels."""

import random
import re
import time
import zlib
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from advertlode.llm import bisectors, cube, order_minhash, path_ratios, periodic_runs, pivot_index, rans, recompression, string_tiling
from advertlode.llm.queries import QUERIES, SQL
from advertlode.llm.stages import tokenizer_path
from advertlode.llm.tokens import Encoder
from advertlode.llm.words import _BASE, BYTE_VALUES, find_words, shingle_hashes, slices

from ..conftest import SF


@pytest.fixture(scope="module")
def docs():
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return {i: (t, s) for i, t, s in rows}


def collected(spark, name):
    return QUERIES[name](spark, SF).collect()


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text)


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def shingles(text, k):
    w = words(lowered(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups(texts, k, percent=80):
    """Component of every id by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in order}, {i: len(s) for i, s in sets.items()}


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def tokenized(text):
    return tokenizer().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    with duckdb.connect() as connection:
        for table in ("documents", "pages", "embeddings"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        answer = connection.execute(SQL[name])
        names = [c[0] for c in answer.description]
        expected = sorted(answer.fetchall())
    assert sorted(tuple(r[n] for n in names) for r in collected(spark, name)) == expected and expected


def test_near_duplicates(spark, docs):
    component, sizes = groups({i: t for i, (t, _) in docs.items()}, 2)
    for row in collected(spark, "op10_lsh_forest"):
        assert (row.n_shingles, row.component_id, row.kept) == (sizes[row.doc_id], component[row.doc_id], component[row.doc_id] == row.doc_id)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2 ** 64 - 1), max_size=60), min_size=2, max_size=5), st.integers(0, 60))
def test_parities_differ_in_no_more_bits_than_members(sets, common):
    from advertlode.llm.lsh_forest import parities

    sets = [s | set(range(common)) for s in sets]
    starts = np.cumsum([0, *map(len, sets)])
    found = parities(np.asarray([x for s in sets for x in sorted(s)], np.uint64), starts)
    full = [s for s in sets if s]
    assert len(found) == len(full)
    for s, bits in zip(full, found):
        for t, others in zip(full, found):
            differ = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in bits ^ others)
            assert differ <= len(s ^ t) and (differ - len(s ^ t)) % 2 == 0


def test_near_duplicates_of_one_large_group(spark):
    from advertlode.llm.lsh_forest import near_duplicates

    rng = random.Random(3)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    texts = {i: " ".join(w if rng.random() > 0.035 else f"n{rng.randrange(10 ** 6)}" for w in base) for i in range(400)}
    texts |= {1000 + i: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for i in range(100)}
    component, _ = groups(texts, 2)
    found = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    wrong = sum(found[i] != component[i] for i in texts)
    assert wrong <= 4 and all(found[i] >= component[i] for i in texts)  # recall 0.99, and nothing linked wrongly


@pytest.mark.parametrize("size", [200, 1200])
def test_near_duplicates_within_a_family_that_is_less_alike(spark, size):
    from advertlode.llm.lsh_forest import near_duplicates

    rng = random.Random(size)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]

    def edited(words, share):
        return [w if rng.random() > share else f"n{rng.randrange(10 ** 6)}" for w in words]

    family = [edited(base, 0.072) for _ in range(size)]  # 0.6 alike, few pairs linked
    family += [edited(words, 0.05) for words in family[:size // 2]]  # each about 0.8 like the one it is made of
    texts = {i: " ".join(words) for i, words in enumerate(family)}
    component, _ = groups(texts, 2)
    found = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert len(set(component.values())) > size // 4 and max(Counter(component.values()).values()) > 1
    assert found == component


def test_token_files(spark, docs):
    start = 0
    for row in sorted(collected(spark, "op1_rans_token_files"), key=lambda r: r.doc_id):
        ids = np.asarray([*tokenized(docs[row.doc_id][0]), 2], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_separator_scan(spark, docs):
    for row in collected(spark, "op3_separator_scan"):
        assert row.n_tokens == len(tokenized(docs[row.doc_id][0])) and row.ordinal == row.doc_id


@cache
def own_encoder():
    return Encoder(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t \x1cab'Zé語½.,|#<>3", max_size=30), min_size=1, max_size=4))
def test_words_are_encoded_as_whole_texts(texts):
    ids, counts = own_encoder().encode(pa.array(texts))
    expected = [tokenized(t) for t in texts]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(1, 50_000), st.integers(0, 9))
def test_blocks_come_back(n, symbols, seed):
    ids = np.minimum(np.random.default_rng(seed).geometric(3 / symbols, n) if symbols > 3 else np.ones(n), 50_256).astype(np.uint32)
    table = rans.Table.of(ids)
    assert table.frequencies.sum() == 1 << rans.PRECISION
    decoder = rans.Decoder(rans.Table.load(table.dump()))
    assert (decoder.block(rans.encode_block(ids, table)) == ids).all()


def test_checkpoints_and_checksums():
    ids = np.random.default_rng(1).integers(0, 500, 600_000).astype(np.uint32)
    table = rans.Table.of(ids)
    raw, decoder = rans.encode_block(ids, table), rans.Decoder(table)
    assert rans.Decoder.checkpoints(raw) > 2
    parts = [decoder.from_checkpoint(raw, n) for n in range(rans.Decoder.checkpoints(raw))]
    assert (np.concatenate(parts) == ids).all() and len(raw) < 600_000 * 9.4 / 8
    for place in (2, 40, len(raw) // 2, len(raw) - 1):
        with pytest.raises(ValueError):
            decoder.block(raw[:place] + bytes([raw[place] ^ 1]) + raw[place + 1:])


def test_decontamination(spark, docs):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()

    def plain(text):
        return re.findall("[0-9a-z\u0080-\U0010ffff]+", lowered(text))

    def covered(item, text):
        """Greedy tiling by comparing all places."""
        a, b, total = plain(item), plain(text), 0
        free_a, free_b = [True] * len(a), [True] * len(b)
        spots = {}
        for j, w in enumerate(b):
            spots.setdefault(w, []).append(j)
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for j in spots.get(a[i], ()):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                        n += 1
                    best = max(best, (n, -i, -j))
            if best[0] < 5:
                return total / max(1, len(a))
            n, i, j = best[0], -best[1], -best[2]
            free_a[i:i + n], free_b[j:j + n] = [False] * n, [False] * n
            total += n

    for row in collected(spark, "op5_string_tiling"):
        shares = {i: covered(t, docs[row.doc_id][0]) for i, t in items if len(plain(t)) >= 5}
        over = {i: s for i, s in shares.items() if s >= 0.5}
        best = min(over, key=lambda i: (-over[i], i)) if over else None
        assert (row.contaminated, row.n_items, row.item_id) == (bool(over), len(over), best)
        assert abs(row.coverage - over.get(best, 0.0)) < 1e-9


def test_reordered_passages(spark):
    rng = random.Random(5)
    item = [f"ord{n}" for n in range(40)]
    parts = [item[i:i + 8] for i in range(0, 40, 8)]
    rng.shuffle(parts)
    text = " ".join(" ".join(p).title() + ", fyll inn." for p in parts)
    docs = spark.createDataFrame([(1, text), (2, " ".join(item[:15])), (3, " ".join(w for w in item for _ in range(2)))], "doc_id long, text string")
    found = string_tiling.contamination(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.coverage) for r in found.collect()} == {(1, 7, 1.0), (2, None, 0.0), (3, None, 0.0)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30))
def test_tiles_are_greedy(item, text):
    marked = string_tiling.tiles(np.asarray(item, np.int64), np.asarray(text, np.int64), 3)
    lengths = [n for _, _, n in marked]
    assert lengths == sorted(lengths, reverse=True)
    used_a, used_b = Counter(), Counter()
    for i, j, n in marked:
        assert item[i:i + n] == text[j:j + n]
        used_a.update(range(i, i + n))
        used_b.update(range(j, j + n))
    assert max(used_a.values(), default=0) <= 1 and max(used_b.values(), default=0) <= 1
    rest = [(i, j) for i in range(len(item) - 2) for j in range(len(text) - 2) if item[i:i + 3] == text[j:j + 3]
            and not any(i + k in used_a or j + k in used_b for k in range(3))]
    assert not rest


def level(sizes, weights):
    """Targets by sharing again and again."""
    target, open_ = {}, dict(sizes)
    left = float(sum(sizes.values()))
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if weights[s] * unit > 3 * sizes[s]]
        if not full:
            return target | {s: weights[s] * unit for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            del open_[s]
    return target


def test_mix(spark, docs):
    rows = collected(spark, "op6_cube_mix")
    sizes = Counter()
    for text, source in docs.values():
        sizes[source] += len(words(text))
    weights = {s: n % 3 + 1 for n, s in enumerate(sorted(sizes))}
    target, taken, largest = level(sizes, weights), Counter(), Counter()
    for row in rows:
        text, source = docs[row.doc_id]
        assert (row.size, row.source_size) == (len(words(text)), sizes[source]) and abs(row.target - target[source]) < 1e-6 * row.target
        assert row.taken % max(1, row.size) == 0 and row.taken <= 3 * row.size
        taken[source] += row.taken
        largest[source] = max(largest[source], row.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes) and len(rows) == len(docs)


def test_flight_balances_in_blocks():
    rng = np.random.default_rng(2)
    sizes = rng.lognormal(5, 1.3, 6000).round()
    chance = np.full(6000, 0.37)
    drawn = cube.fly(chance, sizes, rng, last=True)
    assert set(drawn) <= {0.0, 1.0} and abs(drawn.sum() - 0.37 * 6000) <= 3
    assert abs((drawn * sizes).sum() - 0.37 * sizes.sum()) <= np.median(sizes) * 3
    often = np.mean([cube.fly(np.full(30, 0.3), sizes[:30], np.random.default_rng(i), last=True) for i in range(600)], 0)
    assert abs(often - 0.3).max() < 0.15  # each document by its chance


def test_fingerprints(spark, docs):
    rows = {r.doc_id: r for r in collected(spark, "op8_order_minhash")}
    order = sorted(docs, reverse=True)
    import hashlib

    for i, j in zip(order, [*order[1:], order[0]]):
        text, follower = docs[i][0], docs[j][0]
        third = len(text) // 3
        edited = text[:len(text) - third] + follower[:third]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for i, (text, _) in docs.items():
        assert by_text.setdefault(text, rows[i].fingerprint) == rows[i].fingerprint
    long = [r for r in rows.values() if r.n_chars > 300]
    assert all(r.near_edited > 0.35 for r in long) and np.mean([r.near_edited for r in long]) > 0.6
    assert np.mean([r.near_edited > r.near_next for r in long]) == 1.0


def test_likeness_follows_edits():
    rng = random.Random(1)
    base = [rng.choice("abcdefghij klm") for _ in range(3000)]
    scores = []
    for share in (0, 0.01, 0.03, 0.1, 0.5):
        text = "".join(c if rng.random() > share else "Z" for c in base)
        prints = order_minhash.fingerprints(pa.array(["".join(base), text]))
        scores.append(order_minhash.likeness(prints[:1], prints[1:], np.asarray([False]), np.asarray([False]))[0])
    assert scores[0] == 1.0 and scores == sorted(scores, reverse=True) and scores[-1] < 0.2


def test_quality_on_held_out_labels(spark):
    import os

    sf = "/root/testdata/sf0.01" if os.path.exists("/root/testdata/sf0.01") else SF
    rows = {r.doc_id: r for r in QUERIES["op9_pu_quality"](spark, sf).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    held = [(rows[i].predicted, q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert np.mean([p == q for p, q in held]) > 0.93


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home sidebar-right">
      <header><h2>Site</h2></header><nav><a href=/>Home</a></nav><div id="cookie-notice"><p>We use cookies, dear reader, really.</p></div>
      <div class="page"><div class="story"><h1>Kai &amp; molo</h1><p>Første avsnitt, med flere ord,
      og <a href=x>en lenke</a> i midten.<br>Mer tekst her.</p><script>var a = "<p>no</p>";</script><p>Andre avsnitt &ndash; også langt, og med tegn.
      <form><p>Search here, please, now.</p><input></form></div>
      <aside><p>Related stories, many of them, for you.</p></aside></div>
      <section class="comments"><p>Great post, thanks, friend, really great.</p></section><footer>&copy; Site, all rights, reserved.</footer>"""
    assert path_ratios.main_text(page) == ("Kai & molo\nFørste avsnitt, med flere ord, og en lenke i midten. Mer tekst her.\n"
                                           "Andre avsnitt – også langt, og med tegn.")


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "</i>" * 100_000, "<div>" * 100_000, "<p><b>" * 100_000, "<!--" * 200_000,
                                  "<a href='" * 100_000, "<script>" * 100_000, "< " * 300_000, "<div x=\"" * 60_000, "<ul><li>" * 60_000])
def test_main_text_of_odd_markup_takes_linear_time(page):
    start = time.perf_counter()
    path_ratios.main_text(page)
    assert time.perf_counter() - start < 8


LONG = "Et vanlig avsnitt med ord, tegn og mer, slik det står i en artikkel. " * 6


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div class=w><div class=story>{}</div></div>", "{}"])
@pytest.mark.parametrize("part, texts", [
    ("<ul>" + "<li>kort punkt</li>" * 5 + "</ul>", ["kort punkt"] * 5), ("<ul>" + "<li>kort punkt</li>" * 20 + "</ul>", ["kort punkt"] * 20),
    ("<table>" + "<tr><td>Oslo</td><td>12</td></tr>" * 8 + "</table>", ["Oslo", "12"] * 8), ("<pre>x = f(y)</pre>", ["x = f(y)"]),
    ("<div class=body>" + f"<p>{LONG}</p>" * 12 + "</div>", [LONG.strip()] * 12),
    ("<ol>" + "<li>1</li>" * 9 + "</ol>", ["1"] * 9)])
def test_main_text_keeps_short_and_ordinary_blocks_of_a_region(frame, part, texts):
    for lead, name in ((LONG, "p"), (LONG * 60, "p class=lead"), (LONG * 3000, "p class=lead")):
        page = "<html><body><nav><a href=/>Hjem</a></nav>" + frame.format(f"<h1>Tittel</h1><{name}>{lead}</p>{part}") + "</body></html>"
        assert path_ratios.main_text(page).split("\n") == ["Tittel", lead.strip(), *texts]


def test_main_text_leaves_out_lists_of_links():
    links = "<div class=x><ul>" + "<li><a href=/x>En annen side, om noe annet</a></li>" * 20 + "</ul></div>"
    for story in ("<div class=story>{}</div>", "<article>{}</article>"):
        page = f"<body>{links}{story.format(f'<h1>Tittel</h1><p>{LONG}</p>')}{links}"
        assert path_ratios.main_text(page).split("\n") == ["Tittel", LONG.strip()]


def test_main_text_reads_signs_as_whole_names():
    parts = ["<h2 id='side-effects'>Virkninger</h2>", "<section id='social-impact'><p>Om folk.</p></section>",
             "<div class='legal-text'><p>Om loven.</p></div>", "<div class='article-header'><h1>Tittel</h1></div>", "<p id='notice-period'>Frist.</p>",
             "<p id=side>Ved siden.</p>", "<h3 class='related-work'>Annet arbeid</h3>"]
    texts = ["Virkninger", "Om folk.", "Om loven.", "Tittel", "Frist.", "Ved siden.", "Annet arbeid"]
    barred = "<div class='x sidebar'>Nei.</div><p class=ad>Nei.</p><ul class=pagination><li>Nei.</ul>"
    around = "<div id='cookie-notice'>Nei.</div><div class='footer-top'>Nei.</div><section id=comments>Nei.</section>"
    for frame in ("<article>{}</article>", "<div class=story>{}</div>", "<main>{}</main>"):
        page = "<body>" + around + frame.format(barred.join(parts) + f"<p>{LONG}</p>")
        assert path_ratios.main_text(page).split("\n") == [*texts, LONG.strip()]


def test_main_text_of_a_story_beside_articles():
    story = "<div class=story>" + f"<p>{LONG}</p>" * 5 + "</div>"
    cards = "<div class=grid>" + "<article class=card><h3><a href=/x>Annen sak</a></h3><p>Les mer om det, her.</p></article>" * 9 + "</div>"
    for page in (story + cards, cards + story, f"<body><div>{cards}</div>{story}"):
        assert path_ratios.main_text(page).split("\n") == [LONG.strip()] * 5
    posts = "".join(f"<article class=post><p>{text}</p></article>" for text in (LONG * 8, "Enig.", LONG))
    assert path_ratios.main_text(posts + cards).split("\n") == [(LONG * 8).strip(), "Enig.", LONG.strip()]


def test_words_and_shingles(docs):
    texts = [t for t, _ in docs.values()] + ["", " ", "a", "a b", "\x85x y", "slutt"]
    found, pairs = [], []
    for _, _, data, at in slices(pa.array(texts), 50_000):
        w = find_words(data, at)
        found += [[bytes(data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
        h, first = shingle_hashes(w.hashes(lower=True), w.first, 2)
        pairs += [h[a:b] for a, b in zip(first[:-1], first[1:])]
    assert found == [words(t) for t in texts]
    assert [len(set(p.tolist())) for p in pairs] == [len(shingles(t, 2)) for t in texts]


def test_pipeline_against_brute_force(spark, docs, tmp_path):
    rows = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    kept = {r.doc_id: r.text for r in rows.collect()}
    assert len(kept) > 0.7 * len(docs)
    component, _ = groups(kept, 5)
    one = corpus_pipeline.STAGES[1][1](spark, rows, SF)
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(component.values()))
    # Every row of the whole pipeline is a document of the stages before it, as often as the mix takes it.
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= set(component.values())
    assert max(Counter(r.doc_id for r in out).values()) <= 3
    for row in out[:20]:
        assert row.n_tokens == len(tokenized(docs[row.doc_id][0])) + 1


def cosines(x):
    x = np.asarray(x, float)
    x = x / np.sqrt((x * x).sum(1))[:, None]
    return x @ x.T


def vector_groups(ids, vectors, labels, least):
    """Links of every row and its component by comparing all pairs."""
    near = (cosines(vectors) >= least) & (np.asarray(labels)[:, None] == np.asarray(labels)[None, :])
    np.fill_diagonal(near, False)
    up = np.arange(len(ids))
    for _ in range(len(ids)):
        lower = np.minimum(up, np.where(near, up[None, :], len(ids)).min(1, initial=len(ids)))
        if np.array_equal(lower, up):
            break
        up = lower
    component = {c: min(ids[i] for i in np.flatnonzero(up == c)) for c in set(up.tolist())}
    return near.sum(1).tolist(), [component[c] for c in up.tolist()]


def near_families(rng, dim=24):
    """Vectors of two labels: a large family around one point, small ones, chains, exact copies and single ones."""
    def around(v, far):
        v = v + far * rng.standard_normal(dim) * np.linalg.norm(v) / np.sqrt(dim)
        return v * rng.uniform(0.5, 2)

    points = [rng.standard_normal(dim) for _ in range(60)]
    rows = [around(points[0], f) for f in rng.uniform(0.02, 0.2, 300)] + [around(p, 0.12) for p in points for _ in range(3)] + points
    chain = points[1]
    for _ in range(40):
        chain = around(chain, 0.15)
        rows.append(chain)
    rows += rows[:50]
    return rows


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(pivot_index, "PART", 64)  # the large family takes several blocks
    rng = np.random.default_rng(8)
    rows = near_families(rng)
    labels = rng.integers(0, 2, len(rows)).tolist()
    ids = rng.permutation(len(rows)).tolist()
    found = pivot_index.near_vectors(spark.createDataFrame([(i, v.tolist(), k) for i, v, k in zip(ids, rows, labels)],
                                                           "vec_id long, embedding array<double>, label int")).collect()
    links, component = vector_groups(ids, rows, labels, 0.98)
    assert {r.vec_id: r.n_links for r in found} == dict(zip(ids, links)) and sum(links) > 5000
    assert {r.vec_id: (r.component_id, r.kept) for r in found} == {i: (c, c == i) for i, c in zip(ids, component)}


def test_recall_at_the_threshold():
    """Pairs of cosine 0.98 exactly, where the index misses most."""
    rng = np.random.default_rng(9)
    x, far = (rng.standard_normal((20_000, 64)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1)[:, None]
    far -= (far * x).sum(1)[:, None] * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * far / np.linalg.norm(far, axis=1)[:, None]
    batches = [pa.record_batch([pa.array([b""] * len(v)), pa.array(["l"] * len(v)), pa.array(list(v))], ["node", "label", "vector"]) for v in (x, y)]
    one, two = (np.asarray(b.column("near").flatten()).reshape(-1, pivot_index.NEAREST) for b in pivot_index._described({}, pivot_index.PIVOTS)(iter(batches)))
    shared = [(one[:, :k, None] == two[:, None, :k]).any(2).sum(1) for k in (pivot_index.KEYED, pivot_index.NEAREST)]
    assert ((shared[0] >= 2) & (shared[1] >= pivot_index.SHARED)).mean() > 0.999


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 6), st.integers(0, 2 ** 32))
def test_tournament_finds_the_nearest(k, dim, seed):
    rng = np.random.default_rng(seed)
    x, centroids = rng.integers(-3, 4, (50, dim)), rng.integers(-3, 4, (k, dim))
    found = bisectors.Bisectors.of(centroids.tolist(), dim)
    far = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
    best = found.winners(x)
    assert (best == far.argmin(1)).all() and (found.distances(x, best) == far.min(1)).all()


def test_tournament_at_the_largest_numbers():
    most = bisectors.largest(64)
    corners = np.asarray([[most] * 64, [-most] * 64, [most, -most] * 32])
    found = bisectors.Bisectors.of(corners.tolist(), 64)
    assert found.winners(corners).tolist() == [0, 1, 2] and found.distances(corners, np.asarray([1, 0, 0])).tolist() == [64 * 4 * most ** 2] * 2 + [128 * most ** 2]


def plain_runs(words, least):
    """(start, length, period) of all runs, by comparing the words at each distance."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        equal = [a == b for a, b in zip(words, words[p:])] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            elif not same and start is not None:
                if i - start >= max(least - p, p):
                    found.setdefault((start, i - start + p), p)
                start = None
    return sorted((s, n, p) for (s, n), p in found.items())


def periodic(rng, size, letters):
    words = (rng.choices(range(letters), k=rng.randrange(1, 20)) * size)[:size]
    for _ in range(rng.randrange(4) if size else 0):
        words[rng.randrange(size)] = rng.randrange(letters)
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs(seed):
    rng = random.Random(seed)
    texts = [periodic(rng, rng.choice([0, 1, 11, 12, 13, 40, 150]), rng.choice([1, 2, 3, 6])) for _ in range(6)]
    texts += [[rng.randrange(2) for _ in range(80)]]
    least = rng.choice([4, 6, 12])
    first = np.cumsum([0, *map(len, texts)])
    found = zip(*(c.tolist() for c in periodic_runs.runs_of(np.asarray([w for t in texts for w in t], np.int64), first, least)))
    expected = [(t, *run) for t, words in enumerate(texts) for run in plain_runs(words, least)]
    assert sorted(found) == sorted(expected)


@pytest.mark.parametrize("seed", range(10))
def test_extensions_in_the_grammar(seed):
    rng = random.Random(seed)
    words = [100, *periodic(rng, 400, 3), *periodic(rng, 300, 2), *[1] * 90, 101]
    found = recompression.grammar(np.asarray(words))
    pairs = [rng.sample(range(1, len(words) - 1), 2) for _ in range(500)]
    a, b = np.asarray(pairs).T

    def plain(i, j, step):
        n = 0
        while words[i + step * n] == words[j + step * n]:
            n += 1
        return n

    assert found.forward(a, b).tolist() == [plain(i, j, 1) for i, j in pairs]
    assert found.backward(a, b).tolist() == [plain(i, j, -1) for i, j in pairs]


def test_one_long_text_of_one_word_and_a_long_odd_one():
    start = time.perf_counter()
    assert [c.tolist() for c in periodic_runs.runs_of(np.zeros(150_000, np.int64), np.asarray([0, 150_000]))] == [[0], [0], [150_000], [1]]
    odd = [0], [0, 1]
    while len(odd[1]) < 70_000:
        odd = odd[1], odd[1] + odd[0]
    _, begin, length, period = periodic_runs.runs_of(np.asarray(odd[1]), np.asarray([0, len(odd[1])]))
    assert len(begin) and (length >= 2 * period).all() and time.perf_counter() - start < 60


def test_recompressed_runs(spark, docs):
    import hashlib

    found = {r.doc_id: r for r in collected(spark, "op13_recompressed_runs")}
    assert set(found) == set(docs) and sum(r.n_runs > 0 for r in found.values()) > 5
    for i, (text, _) in docs.items():
        own, h = words(text), zlib.crc32(str(i).encode())
        g, n = h // 10, len(own)
        if n > 3000 and h % 10:  # the plain form takes the square
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[k] if k < a else own[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(own, 12)
        dropped = {k for s, m, p in runs for k in range(s + p, s + m)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        row = found[i]
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (
            len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(w for k, w in enumerate(own) if k not in dropped).encode()).hexdigest()


def plain_fingerprint(text):
    """Order MinHash by its definition: number the strings, sort all by value for each function, take those that follow its
    point, put them into text order, hash."""
    wide, raw = (1 << 64) - 1, text.encode()

    def mixed(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & wide
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & wide
        return x ^ x >> 31

    def value(string):
        return mixed(sum(int(BYTE_VALUES[b]) * pow(int(_BASE), i, 1 << 64) for i, b in enumerate(string)) + len(string) & wide) >> 24

    out, point = [], iter(order_minhash.POINTS.tolist())
    for k, functions in order_minhash.KINDS:
        values, seen = [], Counter()
        for place, string in enumerate([raw[i:i + k] for i in range(max(len(raw) - k + 1, 1))]):
            own = value(string)
            values.append((mixed((own << 24) + seen[own] * 0x9E3779B97F4A7C15 & wide) >> 24 if seen[own] else own, place))
            seen[own] += 1
        values.sort()
        for _ in range(functions):
            at = next(point) >> 24
            begin = next((i for i, v in enumerate(values) if v[0] >= at), 0)
            chosen = [values[(begin + i) % len(values)] for i in range(min(2, len(values)))]
            told = 0
            for own, _ in [*sorted(chosen, key=lambda v: v[1]), (0, 0)][:2] if len(chosen) == 2 else [(0, -1), *chosen]:
                told = mixed((told * 0x9E3779B97F4A7C15 & wide) + (own << 24) + 1 & wide)
            out.append(told >> 48)
    return out


@pytest.mark.parametrize("text", ["a", "ab", "abc", "abcdefgh", "aaaaaaaaaaaaaaaaaaaa", "en to tre fire en to tre fire en to tre", "æøå 日本 " * 9,
                                  " ".join(f"ord{i % 37}" for i in range(150))])
def test_fingerprints_by_definition(text):
    found = order_minhash.fingerprints(pa.array(["noe annet", text, "", "mer"]))
    assert found[1].tolist() == plain_fingerprint(text)


def test_long_texts_select_as_others_do():
    rng = np.random.default_rng(4)
    for strings in (rng.integers(0, 2 ** 64, 5000, np.uint64), rng.integers(0, 2 ** 64, 50, np.uint64)[rng.integers(0, 50, 3000)]):
        one, other = (f(strings, order_minhash.POINTS) for f in (order_minhash._selected, order_minhash._selected_in_long))
        assert (one[0] == other[0]).all() and (one[1] == other[1]).all()


def test_likeness_has_no_step_at_any_length():
    """A text with and without its last character, at every length."""
    rng = random.Random(12)
    for _ in range(20):
        text = "".join(rng.choices("abcdefghij klmnop", k=140))
        prints = order_minhash.fingerprints(pa.array([text[:n] for n in range(1, 140)]))
        near = order_minhash.likeness(prints[:-1], prints[1:], *[np.zeros(138, bool)] * 2)
        assert near[12:].min() > 0.5 and near[40:].min() > 0.75 and near.max() <= 1


@pytest.mark.parametrize("others", [0, 200])
def test_repeated_rows_meet_the_target(spark, others):
    """A row repeated 400 times, alone or beside other documents of its source, against a source of single rows."""
    rows = [(10_000, "ord " * 100, "a", n % 2) for n in range(400)] + [(i, "et to tre " * (5 + i % 20), "a", 0) for i in range(others)]
    rows += [(20_000 + i, "fire fem " * 30, "b", 0) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, odd int").repartition(5)
    units = cube.mixed(docs).collect()
    taken = Counter()
    for r in units:
        taken[r.source] += r.size * r.copies
        assert 0 <= r.copies <= 3 * r.times
    for source, target in {(r.source, r.target) for r in units}:
        assert abs(taken[source] - target) <= 100
    mix = cube.mix(docs)
    found = Counter((r.doc_id, r.source) for r in mix.collect())
    assert found == Counter({(r.doc_id, r.source): r.copies for r in units if r.copies})
    each = [r["n"] for r in mix.where("doc_id = 10000").groupBy("odd").agg(F.count("*").alias("n")).collect()]
    assert len(each) == 2 or found[10_000, "a"] < 400


@pytest.mark.parametrize("name", """comments-section comment-section user-comments reader-comments post-comments share-buttons newsletter-signup newsletter-box
    related-articles ad-slot ad-unit cookie-banner social-links author-promo sidebar-right""".split())
def test_main_text_without_what_stands_in_and_beside_it(name):
    talk = "<p>Fin sak, takk for den!</p><p>Helt enig med deg, dette var bra.</p>"
    links = "<ul><li><a href=/a>Del saken</a></li><li><a href=/b>En annen sak</a></li></ul>"
    for other in (talk, links):
        part = f"<div class='{name}'>{other}</div>"
        for frame in ("<article>{}</article>", "<div class=w><div class=story>{}</div></div>", "<main>{}</main>"):
            for page in (frame.format(f"<h1>Tittel</h1><p>{LONG}</p>{part}"), frame.format(f"<h1>Tittel</h1><p>{LONG}</p>") + part,
                         frame.format(f"<h1>Tittel</h1><p>{LONG}</p>{part}<p>{LONG}</p>")):
                assert set(path_ratios.main_text("<body>" + page).split("\n")) == {"Tittel", LONG.strip()}


def test_main_text_of_two_articles_and_of_lists_of_links():
    page = f"<body><article class=a><h1>Tittel</h1><p>{LONG * 4}</p></article><article class=b><p>Kort, men ekte.</p></article>"
    assert path_ratios.main_text(page).split("\n") == ["Tittel", (LONG * 4).strip(), "Kort, men ekte."]
    links = "<ul>" + "<li><a href=/x>En annen side, om noe</a></li>" * 5 + "</ul>"
    plain = "<ul>" + "<li>Et punkt med <a href=/x>lenke</a> i</li>" * 5 + "</ul>"
    page = f"<body><article><h1>Tittel</h1>{links}<p>{LONG}</p><div>{links}</div>{plain}</article>"
    assert path_ratios.main_text(page).split("\n") == ["Tittel", LONG.strip(), *["Et punkt med lenke i"] * 5]
    deep = "<body>" + "<div>" * 60 + f"<p>{LONG}</p><div class=comments><p>Nei, slett ikke.</p></div>" + "</div>" * 60
    assert path_ratios.main_text(deep) == LONG.strip()
    assert path_ratios.main_text("<body><nav>Meny, og mer.</nav><article></article><div class=ad>Kjøp, nå!</div>") == ""


def test_the_ratios_decide(monkeypatch):
    """With equal scores for all paths what the ratios leave out comes back."""
    pages = [r[0] for r in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall()]
    found = [path_ratios.main_text(p) for p in pages]
    monkeypatch.setattr(path_ratios, "_scores", lambda blocks: {b.path: 1.0 for b in blocks})
    assert all(path_ratios.main_text(p) != f for p, f in zip(pages, found))


def plain_scores(found):
    """The ratios of every path, path by path, and the score from them."""
    import math

    paths = [b.path for b in found]

    def ratio(path, value):
        own = [value(b) for b in found if b.path == path]
        return sum(own) / len(own)

    def near(i, j):
        same = 0
        while same < min(len(paths[i]), len(paths[j])) and paths[i][same] == paths[j][same]:
            same += 1
        return math.exp(-(i - j) ** 2 / 4.5) * (same / max(len(paths[i]), len(paths[j]))) ** 4 if abs(i - j) <= 3 else 0.0

    out = {}
    for path in set(paths):
        total = 0.0
        for value in (lambda b: len(b.text) - b.linked,
                      lambda b: sum(c in ".,;:!?…。，、；：！？¿¡" for c in b.text) * (len(b.text) - b.linked) / len(b.text)):
            own = [i for i, p in enumerate(paths) if p == path]
            smooth = [sum(near(i, j) * ratio(paths[j], value) for j in range(len(paths))) / sum(near(i, j) for j in range(len(paths))) for i in own]
            total += math.log1p(sum(smooth) / len(own))
        out[path] = total * (0.005 if any(b.sign[0] for b in found if b.path == path) else 1.0)
    return out


@pytest.mark.parametrize("seed", range(15))
def test_scores_by_definition(seed):
    rng = random.Random(seed)
    parts = ["<p>Kort.</p>", "<p>En setning, med <a href=x>lenke</a>.</p>", "<ul><li>a<li>b, c</ul>", "<div class=x><p>Noe, her!</p></div>",
             "<div class=comments><p>Ja, takk.</p></div>", "<nav><a href=/>Hjem</a></nav>", f"<div><div><p>{LONG}</p></div></div>", "<h2>Tittel</h2>"]
    found = path_ratios.blocks("<body>" + "".join(rng.choices(parts, k=rng.randrange(1, 25))))
    scores, expected = path_ratios._scores(found), plain_scores(found)
    assert scores.keys() == expected.keys() and all(abs(scores[p] - expected[p]) < 1e-9 for p in scores)
