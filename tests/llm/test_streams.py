"""URL cascades, mixing, SentencePiece ids, archives and the pipeline."""

import gzip
import random
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from compare import connect, difference
from touchline.llm import mixing, near_texts, pieces, queries, urls, warc
from touchline.session import scratch

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_url_cascade", "op7_warc_revisits"])
def test_query_equals_sql(spark, name):
    assert difference(contract.queries()[name](spark, FOLDER), connect(FOLDER), contract.oracle_sql()[name]) is None


# --- urls --------------------------------------------------------------------------------------

ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a", "x://example.com?en/", "x://com/", "x://com", "x://a.com//en/",
    "x://example.com/en", "x://example.com/EN/", "x://notexample.com/en/", "x://example.com:80/en/", "x://a/b://example.com/en/",
    "x://net/es/", "x://b.net/fr/?q", "x://.net/es/", "x://ÄÖ.net/es/é", "x://spam-farm.example.org/", "x://a.spam-farm.example.org",
    "x://line\nbreak.net/es/\nend#f", "x://" + "a." * 200 + "com/" + "p" * 5000, "x://net/es/", "x://net/es/",
]


def _judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in queries.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits)[1:])
    listed = any(host == h or host.endswith("." + h) for h in queries.HOSTS)
    return host, path, None, "block" if listed else "allow"


def test_rules_on_odd_urls(spark):
    pages = spark.createDataFrame(list(enumerate(ODD_URLS)), "page_id long, url string").withColumn("HOST", F.lit(1))
    rules = queries._values(spark, queries.RULES, "host, path, verdict")
    hosts = queries._values(spark, [(h,) for h in queries.HOSTS], "host")
    rows = urls.judge(pages, rules, hosts).orderBy("page_id").collect()
    assert [tuple(r)[2:] for r in rows] == [_judged(u) for u in ODD_URLS]
    assert urls.judge(pages.where("false"), rules, hosts).count() == 0
    free = urls.judge(pages, rules.where("false")).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in free] == [(None, "allow")]


def test_cascade_is_exact_on_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS", 2)  # many wrong passes, so several levels
    universe = spark.range(4000).select(F.concat(F.lit("key"), "id").alias("key"))
    listed = universe.where("substr(key, -1) IN ('3', '7')").unionByName(universe.where("key IS NULL"))
    cascade = urls.build(listed, universe)
    assert len(cascade.levels) > 3
    right = F.col("key").substr(-1, 1).isin("3", "7") == cascade.has(F.col("key"))
    assert universe.where(~right).count() == 0
    assert urls.build(listed.where("false"), universe).levels == []


# --- mixing ------------------------------------------------------------------------------------

def _edf(units, period):
    """Earliest deadline first, tick by tick."""
    order, done, ran = sorted(units, key=lambda s: (-units[s], s)), dict.fromkeys(units, 0), []
    for t in range(period):
        free = [s for s in order if done[s] < units[s] and done[s] * period // units[s] <= t]
        best = min(free, key=lambda s: (-(-(done[s] + 1) * period // units[s]), order.index(s)))
        ran.append((best, done[best], t))
        done[best] += 1
    return ran


@pytest.mark.parametrize("units", [{"a": 5, "b": 3, "c": 2}, {"a": 50, "b": 17, "c": 17, "d": 16}, {"x": 100}, {"p": 99, "q": 1}])
def test_schedule_equals_simulation_and_stays_within_a_block(spark, units):
    period = sum(units.values())
    table = mixing.schedule(spark.createDataFrame(list(units.items()), "source string, units int"), period)
    rows = sorted(((r.source, r.place, r.tick) for r in table.collect()), key=lambda r: r[2])
    assert rows == _edf(units, period)
    for s, n in units.items():
        ran = np.cumsum([r[0] == s for r in rows])
        assert np.abs(ran - np.arange(1, period + 1) * n / period).max() < 1


def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 50)
    counts = {"big": 900, "mid": 240, "small": 160, None: 80, "unweighed": 10}
    rows = [(i, s) for s, n in counts.items() for i in range(n)] + [(None, "big"), (3, "big"), (3, "big")]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumn("Tick", F.lit("x")).withColumn("_key", F.lit(1))
    targets = spark.createDataFrame([("big", 2.0), ("mid", 1.0), ("small", 1.0), (None, 0.5), ("absent", 0.5), ("none", 0.0)],
                                    "source string, weight double")
    out = mixing.mix(docs, targets, period=50, block=4).toPandas()
    assert len(out) == len(rows) and "_key" in out
    assert not out[out.source == "unweighed"].used.any() and out[out.source == "unweighed"].tick.isna().all()
    known = out[out.source != "unweighed"].fillna({"source": "-"})
    blocks = known.drop_duplicates(["source", "block"])
    assert not blocks.tick.duplicated().any()
    assert (blocks.release <= blocks.tick).all() and (blocks.tick < blocks.deadline).all()
    sizes = known.groupby(["source", "block"]).size()
    assert sizes.max() == 4 and (sizes < 4).sum() <= known.source.nunique()
    share = dict(mixing.units(targets, 50).rdd.map(lambda r: (r.source or "-", r.units)).collect())
    assert sum(share.values()) == 50
    first = blocks.groupby("source").tick.max().min()
    for s, group in blocks.groupby("source"):
        ran = np.searchsorted(np.sort(group.tick), np.arange(1, first))
        assert np.abs(ran - np.arange(1, first) * share[s] / 50).max() < 1
    # Half of the weight is there until the sources that hold it end.
    assert 0 < known.used.sum() < len(known)


def test_mixture_follows_the_weights_over_many_periods(spark):
    counts = {"hot": 27_000, **{f"s{i}": 1_500 for i in range(5)}}
    docs = spark.createDataFrame([(i, s) for s, n in counts.items() for i in range(n)], "doc_id long, source string")
    weights = {"hot": 0.9, **{f"s{i}": 0.02 for i in range(5)}}
    targets = spark.createDataFrame(list(weights.items()), "source string, weight double")
    out = mixing.mix(docs, targets).toPandas()
    assert (out.release <= out.tick).all() and (out.tick < out.deadline).all()
    blocks = out.drop_duplicates(["source", "block"])
    assert sorted(blocks.tick) == list(range(len(blocks)))
    first = blocks.groupby("source").tick.max().min()
    assert first > 3000
    for s, group in blocks.groupby("source"):
        ran = np.searchsorted(np.sort(group.tick), np.arange(1, first))
        assert np.abs(ran - np.arange(1, first) * weights[s]).max() < 1


def test_units_are_the_proportions():
    assert mixing._parts({"a": 0.9, "b": 0.1}, 1000) == {"a": 900, "b": 100}
    assert mixing._parts({"a": 1e9, "b": 1.0, None: 1.0}, 10) == {"a": 8, "b": 1, None: 1}


def test_mixing_whole_tables(spark):
    out = contract.queries()["op2_pfair_mix"](spark, FOLDER)
    assert out.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(spark.range(30).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source")), period=20)


# --- ids ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(queries.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)


def test_ids_equal_the_library(spark, library):
    found = contract.queries()["op10_piece_ids"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_ids == len(r.ids) and r.round_trip


def test_ids_of_random_texts_equal_the_library(vocabulary, library):
    rng, codec = random.Random(1), pieces.Codec(vocabulary)
    bits = ["a", "e", "th", "the", "ing", " ", "  ", " " * 23, "\n", "\t", "é", "ß", "漢", "\U0001f600", "▁", "!", "1", "\u200b",
            "and", "tion", "'s", "http", "://", ".com", "\r\n", "\u0000", "=" * 40]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        packed = codec.encode(text)
        assert np.frombuffer(packed, np.int32).tolist() == library.encode(text), repr(text)
        assert codec.decode(packed) == library.decode(library.encode(text))


def test_window_stays_bounded(vocabulary, monkeypatch):
    """Over a long stretch without a free cut, boundaries leave the window as paths converge."""
    spans = []
    path = pieces.Encoder._path
    monkeypatch.setattr(pieces.Encoder, "_path", staticmethod(lambda last, begin, done, end: spans.append(len(last)) or path(last, begin, done, end)))
    text = "▁" + "internationalisation" * 500
    encoder = pieces.Encoder(vocabulary)
    assert "".join(map(encoder.name, encoder.pieces(text))) == text and max(spans) <= 6 * vocabulary.reach


def test_odd_texts_and_back(spark, vocabulary):
    texts = [None, "", " ", "x" * 50_000, "tie tie", "tie tie", "é\u0000\U0001f600 \n\n  end "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("IDS", F.lit(3))
    found = pieces.with_ids(docs, vocabulary)
    rows = found.orderBy("doc_id").collect()
    assert (rows[0].ids, rows[0].n_ids, rows[0].round_trip) == (None, 0, None)
    assert rows[1].ids == [] and all(r.round_trip for r in rows[1:])
    assert rows[4].ids == rows[5].ids
    back = pieces.with_text(found.drop("text"), vocabulary).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts
    assert pieces.with_ids(docs.where("false"), vocabulary).count() == 0


# --- archives ----------------------------------------------------------------------------------

@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_archives_of_odd_pages(spark, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    same, tricky = "s" * 100, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 5
    pages = [(5, "http://a", same), (3, "http://b\r\nX: y", same), (3, "http://c%0D", same), (None, None, same), (9, "u", "s" * 99), (8, "u", "s" * 99),
             (1, None, None), (2, "é", ""), (4, "t", tricky), (6, "t", tricky), (7, "l", "long " * 100_000), (None, "n", "only null" * 20)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    folder = scratch(spark, "odd-archives")
    warc.write(docs, folder)
    read = warc.read(spark, folder, payload=True)
    stored = [(r.page_id, r.url, bytes(r.payload).decode()) for r in read.where("record_type = 'response'").collect()]
    key = lambda r: (str(r[0]), str(r[1]), str(r[2]))
    assert sorted(stored, key=key) == sorted(
        [(i, u, h or "") for i, u, h in pages if (i, h) not in [(5, same), (None, same), (6, tricky)]], key=key)
    out = {(r.page_id, r.url): r for r in warc.resolve(warc.read(spark, folder)).collect()}
    assert len(out) == len(pages)
    assert out[5, "http://a"].refers_to == 3 and out[5, "http://a"].payload_bytes == 100 and out[None, None].refers_to == 3
    assert out[9, "u"].record_type == out[8, "u"].record_type == "response" and out[1, None].payload_bytes == 0
    assert out[6, "t"].payload_digest == out[4, "t"].payload_digest
    empty = scratch(spark, "no-archives")
    warc.write(docs.where("false"), empty)
    assert warc.read(spark, empty).count() == 0


def test_archive_is_plain_warc(spark, tmp_path):
    docs = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200)], "page_id long, url string, html string")
    warc.write(docs, f"file://{tmp_path}/w")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path, "w").glob("part-*.gz"))
    assert text.count(b"WARC/1.1\r\n") == 2 and text.endswith(b"\r\n\r\n") and text.count(b"x" * 200) == 1
    assert b"WARC-Refers-To: <urn:page:1>\r\n" in text


# --- the pipeline ------------------------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionByName(docs.limit(3).select(
        (F.col("doc_id") + 100_000).alias("doc_id"), "text", "lang", "source", "n_chars"
    )).unionByName(docs.limit(2))
    extra = docs.withColumn("Score", F.lit("kept")).withColumn("used", F.lit(7)).withColumn("cid", F.lit(None).cast("int"))
    step = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, step = step, stage(spark, step, FOLDER)
        assert step.columns == extra.columns, name
        assert step.exceptAll(before).count() == 0, name
        path = scratch(spark, "pipeline-test")
        step.write.parquet(path)
        step = spark.read.parquet(path)
        assert step.count() > 0
    third = step.select("doc_id", "text").collect()
    assert len({r.doc_id for r in third}) == len(third) and max(r.doc_id for r in third) < 100_000
    sets = [set(s.tolist()) for s in near_texts.shingles([r.text for r in third])]
    assert not any(100 * len(a & b) >= 85 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a and b)
    last = corpus_pipeline.STAGES[-1][1](spark, step, FOLDER)
    assert last.count() == len(third) and last.where("NOT round_trip").count() == 0


def test_near_duplicate_stage_links_at_80(spark):
    words = [f"w{i}" for i in range(104)]
    texts = [words, words[:90] + ["x"] * 1 + words[91:], words[:60] + ["y", "z"] + words[62:98], words[50:] + words[:50][::-1]]
    sets = [set(s.tolist()) for s in near_texts.shingles([" ".join(t) for t in texts])]
    assert 80 <= 100 * len(sets[0] & sets[2]) / len(sets[0] | sets[2]) < 85
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, FOLDER).collect()) == [0, 3]


def test_near_duplicate_stage_where_ids_repeat(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    rows = [(1, a), (2, b), (2, a), (3, c), (3, c + " more"), (4, None), (4, None), (4, ""), (5, "x"), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, FOLDER).collect()]
    assert len(kept) == 6 and set(kept) < {(1, a), (2, b), (3, c), (3, c + " more"), (4, None), (4, ""), (5, "x")}


def test_mixture_stage_keeps_all_documents_in_the_order_of_the_schedule(spark):
    counts = {"hot": 900, "a": 100, "b": 100}
    docs = spark.createDataFrame([(i, s) for s, n in counts.items() for i in range(n)], "doc_id long, source string")
    docs = docs.withColumn("Tick", F.lit(0))
    kept = [tuple(r) for r in corpus_pipeline.mixed(spark, docs, FOLDER).collect()]
    assert sorted(kept) == sorted(map(tuple, docs.collect()))
    ticks = {(r.source, r.doc_id): r.tick for r in mixing.mix(docs.drop("Tick")).collect()}
    order = [ticks[s, i] for i, s, _ in kept]
    assert order == sorted(order)


def test_ids_come_in_the_order_of_the_mixture(spark, tmp_path):
    """A reader takes the largest file first, here the last; the order holds whether or not files lie between the stages."""
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.substring(F.lit("abc"), (F.col("id") % 7 % 3).cast("int") + 1, 1).alias("source"))
    order = [r.doc_id for r in mixing.mix(docs).orderBy("tick", "doc_id").collect()]
    texts = spark.createDataFrame([(i, f"w{i} " * n) for n, i in enumerate(order)], "doc_id long, text string")
    docs.join(texts, "doc_id").withColumn("lang", F.lit("en")).write.parquet(f"{tmp_path}/docs")
    mixed = corpus_pipeline.mixed(spark, spark.read.parquet(f"{tmp_path}/docs"), FOLDER)
    mixed.write.option("maxRecordsPerFile", 100).parquet(f"{tmp_path}/mixed")
    written = spark.read.parquet(f"{tmp_path}/mixed")
    assert [r.doc_id for r in written.collect()] != order
    for given in (mixed, written):
        found = corpus_pipeline.as_ids(spark, given, FOLDER).select("doc_id", "position").collect()
        assert [r.doc_id for r in found] == order == [r.doc_id for r in sorted(found, key=lambda r: r.position)]


def test_pipeline_without_documents_or_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "source", "lang", "ids", "n_ids", "round_trip"]
