"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from advertlode.llm import (bisectors, cube, line_spread, lsh_forest, merkle, order_minhash, path_ratios, periodic_runs, pivot_index, pu_quality,
                            separators, string_tiling, token_files)
from advertlode.llm import queries
from advertlode.llm.queries import QUERIES
from advertlode.llm.stages import tokenizer_path
from advertlode.llm.tables import shared_path

LONG = "lang tekst med ord " * 20_000
# Columns that share names with the operators' own.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, node string, copies int, size long, "
          "component string, _key string, _text string, hash long, id long, `rows` int, place string")


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "A b c d e f g h"), (3, ""), (4, None), (5, " \n\t "), (6, "x"),
             (7, "x"), (None, "a b c d e f g h"), (None, None), (8, LONG), (9, "é 日本 語 ½ <|x|>  to  rom"), (9, "annen tekst")]
    rows = [(i, t, "l", None if n % 3 == 0 else f"s{n % 3}", 5, "k", "n", 7, 8, "c", "_k", "_t", 1, 2, 3, "p") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.select(name).collect()), key=repr)


def test_near_duplicates(odd):
    found = lsh_forest.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id not in (None, 9)}
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 1, 3, 4, 5, 6, 6, 8]
    assert [by_id[i].n_shingles for i in (1, 3, 4, 5, 6)] == [7, 0, 0, 0, 1] and sum(r.kept for r in found if r.doc_id == 1) == 2
    assert {(r.component_id, r.kept) for r in found if r.doc_id is None} == {(1, False), (None, False)}
    assert lsh_forest.near_duplicates(odd.limit(0)).count() == 0
    stay = lsh_forest.one_of_each(odd)
    assert stay.columns == odd.columns and ids(stay) == sorted([1, 3, 4, 5, 6, None, 8, 9, 9], key=repr)
    assert lsh_forest.one_of_each(odd.limit(0)).count() == 0


def test_decontamination(spark, odd):
    benchmark = spark.createDataFrame([(1, "A b, c d e f!"), (1, "A b, c d e f!"), (2, None), (3, ""), (None, "b c"), (4, "ikke der i det hele")],
                                      "item_id long, text string")
    found = string_tiling.contamination(odd, benchmark)
    assert ids(found) == ids(odd) and ids(found.where("contaminated")) == [1, 1, 2, None]
    assert {(r.item_id, r.n_items, r.coverage) for r in found.where("contaminated").collect()} == {(1, 1, 1.0)}
    clean = string_tiling.decontaminated(odd, benchmark)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 4
    for docs, items in ((odd.limit(0), benchmark), (odd, benchmark.limit(0))):
        assert string_tiling.decontaminated(docs, items).count() == docs.count()


def test_mix(odd):
    rows = cube.mixed(odd)
    assert rows.agg(F.sum("times")).first()[0] == odd.count()
    assert rows.where("copies > 3 * times OR copies < 0 OR size < 0").count() == 0
    assert {r.size for r in rows.where("doc_id IN (3, 4, 5)").collect()} == {0}
    mix = cube.mix(odd)
    assert mix.columns == odd.columns and mix.count() == rows.agg(F.sum("copies")).first()[0]
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, cube.mixed(odd.repartition(5)).collect()))
    assert cube.mixed(odd.limit(0)).count() == 0 and cube.mix(odd.limit(0)).count() == 0
    assert {r.copies for r in cube.mixed(odd.where("doc_id IN (3, 4)")).collect()} == {0}


def test_token_files(spark, odd):
    for docs in (odd, odd.limit(0)):
        path = shared_path(spark, "files")
        token_files.write_token_files(docs, path, tokenizer_path())
        found = token_files.token_digests(spark, path).orderBy("start").collect()
        assert ids(docs) == sorted((r.doc_id for r in found), key=repr)
        at = 0
        for row in found:
            assert row.start == at
            at += row.n_tokens
        assert [r.n_tokens for r in found if r.doc_id in (3, 4)] == [1, 1][:len(found)]
        assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda i: -1 if i is None else i)
    plain = token_files.read_token_files(spark, path).count()
    assert plain == 0


def test_separator_scan(spark, odd):
    for docs in (odd, odd.limit(0)):
        path = shared_path(spark, "flat")
        separators.write_flat_files(docs, path, tokenizer_path(), block=7)
        found = separators.counted(docs, separators.documents(spark.read.parquet(path))).collect()
        assert ids(docs) == sorted((r.doc_id for r in found), key=repr)
        assert sorted(r.n_tokens for r in found if r.doc_id in (3, 4)) == [0, 0][:len(found)]

        path = shared_path(spark, "unordered")
        separators.write_flat_files(docs, path, tokenizer_path(), block=7, ordered=False)
        files = spark.read.parquet(path)
        as_read = separators.named(files, separators.documents(files)).collect()
        assert sorted((repr(r.doc_id), r.n_tokens) for r in as_read) == sorted((repr(r.doc_id), r.n_tokens) for r in found)
        assert sorted(r.ordinal for r in as_read) == list(range(len(as_read)))
        assert [r.doc_id for r in sorted(as_read, key=lambda r: r.ordinal)] == [r.doc_id for r in sorted(found, key=lambda r: r.ordinal)]


def test_separator_scan_of_texts_that_name_the_end(spark):
    texts = ["a <|endoftext|> b", "c d e", "<|endoftext|>", None, "x<|endoftext|><|endoftext|>", "f g"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = shared_path(spark, "named-ends")
    separators.write_flat_files(docs, path, tokenizer_path(), block=7, ordered=False)
    files = spark.read.parquet(path)
    found = {r.doc_id: r.n_tokens for r in separators.named(files, separators.documents(files)).collect()}
    library = Tokenizer.from_file(tokenizer_path())
    library.encode_special_tokens = True
    assert found == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)} and found[2] == 7
    ends = separators.documents(files)
    for wrong in (ends.where("number < 5"), ends.unionByName(ends.withColumn("number", F.col("number") + 6))):
        with pytest.raises(Exception, match="not both listed and ended"):
            separators.named(files, wrong).collect()


def test_separator_scan_leaves_no_words_in_workers(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 50), i -> concat('ord', id, 'x', i))) AS text").repartition(2)
    write = separators._flat(tokenizer_path(), separators.END, separators.BLOCK)

    def words_after(batches):
        import pyarrow as pa

        for _ in write(batches):
            pass
        held = vars(pa)["_advertlode_memory"]["encoders"][tokenizer_path(), True]
        yield pa.record_batch([pa.array([len(held._spaced) + len(held._leading) + len(held._tails) + len(held._flat)])], ["n"])

    found = docs.selectExpr("doc_id", "xxhash64(text) AS tie", "text").mapInArrow(words_after, "n long").collect()
    assert [r.n for r in found] == [0, 0]


def test_fingerprints(odd):
    found = order_minhash.followed(odd).collect()
    assert sorted((r.doc_id for r in found), key=repr) == ids(odd)
    by_id = {r.doc_id: r for r in found}
    assert by_id[6].fingerprint == by_id[7].fingerprint != "" == by_id[3].fingerprint == by_id[4].fingerprint
    assert by_id[4].near_next == 1.0 and by_id[7].near_next == 1.0 and by_id[6].near_next == 0.0
    assert by_id[3].edited_sha256 == hashlib.sha256(b"").hexdigest() and by_id[8].n_chars == len(LONG)
    assert order_minhash.followed(odd.limit(0)).count() == 0
    single = order_minhash.followed(odd.where("doc_id = 6")).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"x").hexdigest()


def test_quality(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, 1), (8, 1), (None, 1), (7, None)], "doc_id long, quality int")
    positive, unlabelled = pu_quality.sample(odd, labels)
    model = pu_quality.fit(positive, unlabelled)
    found = pu_quality.quality_scores(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert {r.score for r in found if r.doc_id in (3, 4, 5)} == {0.0}
    assert pu_quality.quality_scores(odd.limit(0), model).count() == 0
    assert pu_quality.scored(odd, model, "_score").columns == [*odd.columns, "_score"]
    with pytest.raises(ValueError):
        pu_quality.fit(*pu_quality.sample(odd, labels.limit(0)))


def test_quality_without_texts_positives_or_unlabelled_texts(spark, odd, tmp_path):
    docs = spark.createDataFrame([(i, ("god tekst, med ord " if i % 2 else "XX 00 !! ") * (i % 7 + 1)) for i in range(40)], "doc_id long, text string")
    every = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    for name, texts, labels in (("empty", docs.limit(0), every), ("none", docs, every.limit(0)), ("bad", docs, every.where("quality = 0")), ("all", docs, every)):
        sf = str(tmp_path / name)
        texts.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        found = {r.doc_id: r.score for r in QUERIES["op9_pu_quality"](spark, sf).collect()}
        stayed = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).count()
        assert len(found) == (0 if name == "empty" else 40)
        if name == "all":
            assert min(found[i] for i in range(1, 40, 2)) > max(found[i] for i in range(0, 40, 2))
        else:
            assert set(found.values()) <= {0.5} and stayed == len(found)


def test_quality_learns_from_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(pu_quality, "POSITIVES", 30)
    monkeypatch.setattr(pu_quality, "UNLABELLED", 90)
    rows = [(i, f"tekst {'a' * (i % 50)} nummer {i}") for i in range(1500)] + [(1, f"gjentatt {i} igjen") for i in range(700)]
    rows += [(i % 1300 + 200, f"tekst {'b' * (i % 40)} {i}") for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    drawn = [pu_quality.sample(docs.repartition(n, *by), labels.repartition(n)) for n, *by in ((1,), (7,), (5, "text"))]
    for positive, unlabelled in drawn:
        assert len(positive) == 30 and 64 <= len(unlabelled) <= 90
        assert (positive == drawn[0][0]).all() and (unlabelled == drawn[0][1]).all()
    for hot in range(200):  # whichever ids are drawn, one that repeats is one text
        if not int(spark.range(hot, hot + 1).select(pu_quality.held_out(F.col("id"))).first()[0]):
            break
    few = spark.createDataFrame([(hot, f"gjentatt {i} igjen") for i in range(500)] + [(1000 + i, f"annen {i}") for i in range(70)], "doc_id long, text string")
    positive, unlabelled = pu_quality.sample(few, labels)
    assert len(positive) == 1 and len(unlabelled) <= 71


def test_lines(spark):
    rows = [(i, f"felles\n egen {i}\n\n  felles ", f"s{i}", "k") for i in range(4)]
    rows += [(4, None, "s4", "k"), (5, "", "s5", "k"), (6, "felles", None, "k"), (7, "sjelden\nfelles", "s0", "k"), (7, "sjelden\nfelles", "s0", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place string")
    found = line_spread.without_boilerplate(docs, sites=4)
    texts = {r.doc_id: (r.text, r._lines, r._removed) for r in found.collect()}
    assert texts[1] == (" egen 1\n", 4, 2) and texts[4] == (None, 0, 0) and texts[5] == ("", 1, 0)
    assert texts[6] == ("", 1, 1) and texts[7] == ("sjelden", 2, 1) and found.count() == len(rows)
    assert line_spread.without_boilerplate(docs, sites=5).where("_removed > 0").count() == 0
    assert line_spread.without_boilerplate(docs.limit(0)).count() == 0


def test_audit(spark):
    def leaves(rows):
        return merkle.leaves(spark.createDataFrame(rows, "file string, seq long, record string"))

    rows = [(f, n, f"{f}{n} " + "x" * 30_000) for f in ("a", "b") for n in range(40)] + [("c", 1, None), ("c", 1, "z"), (None, 1, "n")]
    first = leaves(rows)
    assert merkle.audit(first, leaves(rows)).count() == 0
    changed = F.when((F.col("file") == "a") & (F.col("seq") == 39), F.lit("0")).otherwise(F.col("hash"))
    extra = first.where("file = 'b' AND seq = 1").withColumn("offset", F.lit(10 ** 9))
    other = first.withColumn("hash", changed).where("NOT (file = 'b' AND seq = 7)").unionByName(extra)
    other = other.unionByName(first.where("file = 'b' AND seq = 7").limit(0))
    found = {(r.file, r.seq, r.kind) for r in merkle.audit(first, other).collect()}
    assert found == {("a", 39, "changed"), ("b", 7, "missing"), ("b", 1, "extra")}
    assert merkle.audit(first, first.limit(0)).where("kind = 'missing'").count() == len(rows)
    assert merkle.audit(first.limit(0), first.limit(0)).count() == 0
    null = spark.createDataFrame([(None, None, None)], "page_id long, url string, html string")
    assert null.select(merkle.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("r")).first().r.endswith("Content-Length: 0\r\n\r\n\r\n\r\n")


def test_audit_of_pages_with_repeated_and_null_ids(spark, tmp_path):
    rows = [(i, "u", f"side {i}") for i in range(200)] + [(97, "u", f"igjen {n}") for n in range(20)] + [(5, "u", f"og {n}") for n in range(20)]
    rows += [(99, "u", f"borte {n}") for n in range(3)] + [(None, "u", f"uten {n}") for n in range(4)] + [(5, "u", "lik"), (5, "u", "lik")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted((r.page_id, r.kind) for r in QUERIES["op4_merkle_audit"](spark, str(tmp_path)).collect())
    kinds = {0: "changed", 1: "changed", 2: "missing"}
    assert found == sorted((i, kinds[i % 97]) for i, *_ in rows if i is not None and i % 97 in kinds)


def test_main_text(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x")],
                                  "page_id long, url string, html string, text string")
    found = path_ratios.extracted(pages)
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found.collect()) == [(0, "a", 1), (1, "", 0), (1, "a", 1), (2, "", 0)]
    assert path_ratios.extracted(pages.limit(0)).count() == 0


def test_pipeline_stages_keep_the_columns(spark, odd, tmp_path):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 1), (8, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "p q r s t u v")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mix", "token_files"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, str(tmp_path)).columns == odd.columns


INF, NAN = float("inf"), float("nan")
# Columns that share names with the operators' own.
VECTORS = "vec_id long, embedding array<float>, label int, id long, node string, vector string, near int, times int, cluster int, x int, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", "v", 2, 3, 4, 5, 6) for r in rows], VECTORS).repartition(3)


def test_near_vectors(spark):
    a, b, far = [1.0, 0.0, 0.0], [2.0, 0.05, -0.0], [0.0, 1.0, 0.0]
    odd = vectors(spark, [(1, a, 1), (2, a, 1), (2, a, 1), (3, b, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
                          (9, [1.0, None, 0.0], 1), (10, [NAN, 0.0, 0.0], 1), (11, [INF, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, far, 1),
                          (None, a, 1), (None, far, 2), (14, [3e38, 0.0, 0.0], 3), (15, [1e-38, 1e-40, 0.0], 3)])
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivot_index.near_vectors(odd).collect()), key=repr)
    expected = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 4, 1, False), (None, 4, 1, False), (None, 0, None, False),
                (14, 1, 14, True), (15, 1, 14, False), *[(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)]]
    assert found == sorted(expected, key=repr)
    assert pivot_index.near_vectors(odd.limit(0)).collect() == []
    assert {r.component_id for r in pivot_index.near_vectors(odd.where("vec_id in (6, 8)")).collect()} == {6, 8}


def test_clusters(spark):
    one, two = [0.5] * 64, [-0.25] * 64
    rows = [(1, one, 1), (1, one, 1), (2, two, None), (None, two, 1), (3, None, 1), (4, one[:63], 1), (5, [*one[:63], None], 1), (6, [*one[:63], NAN], 1),
            (7, [*one[:63], INF], 1), (8, [*one[:63], 3e38], 1), (9, [*one[:63], -7.3], 1)]
    found = bisectors.clustered(vectors(spark, rows))
    assert ids(found.rows, "id") == sorted([1, 1, 2, None, 9], key=repr) and len(found.centroids) == 5
    assert {r.distance for r in found.rows.collect()} == {0}
    by_id = {r.id: r.cluster for r in found.rows.collect()}
    assert found.centroids[by_id[9]] == [32] * 63 + [-468]  # floor(64 * -7.3)
    none = bisectors.clustered(vectors(spark, rows).where("vec_id > 2 AND vec_id < 9"))
    assert none.rows.collect() == [] and none.centroids == []
    assert bisectors.clustered(vectors(spark, rows), k=1).centroids == [bisectors.clustered(vectors(spark, rows), k=1, rounds=5).centroids[0]]
    with pytest.raises(ValueError):
        bisectors.clustered(vectors(spark, rows), k=10_000)


def test_runs(spark, odd):
    found = periodic_runs.periodic_runs(odd)
    assert ids(found) == ids(odd)
    long = found.where("doc_id = 8").first()
    assert long.n_words == 80_000 and long.collapsed == "lang tekst med ord"
    assert [tuple(r) for r in long.runs] == [(0, 80_000, 4)]
    for row in found.where("doc_id IN (3, 4, 5)").collect():
        assert (row.n_words, row.runs, row.collapsed) == (0, [], "")
    assert {r.collapsed for r in found.where("doc_id = 9").collect()} == {"é 日本 語 ½ <|x|> to rom", "annen tekst"}
    assert periodic_runs.periodic_runs(odd.limit(0)).collect() == []
    tables = spark.createDataFrame([(10, "a b c " * 6), (10, "a b c " * 6), (11, None), (12, " "), (None, "x " * 20)], "doc_id long, text string")
    repeated = {r.doc_id: r.text for r in queries._with_repeated_tails(tables).collect()}
    assert repeated[11] in (None, "") and len(repeated) == 4  # ids on more rows, and none, are rows like others
    assert repeated[None] == "x " * 20  # no id, no hash: the text as it is
