"""Sources and sinks: news XML, delimited lines, export, de-duplication, index store."""

import os

from pyspark.sql import functions as F

from corpora import FIXTURES
from lodestar.sources import delimited, news_xml
from lodestar.sources.documents import dedupe_docs, from_documents
from lodestar.sources.store import IndexStore


def test_news_xml(spark):
    rows = {r.doc_id: r for r in news_xml.read_news_xml(spark, os.path.join(FIXTURES, "news.xml")).collect()}
    assert sorted(rows) == [2286, 2287, 2288]
    a = rows[2286]
    assert a.title == "MEXICO: Harbour towns count their fishing boats."
    assert a.byline == "Pat Invented"
    assert str(a.date) == "1996-08-20"
    assert a.countries == ["MEX"] and a.industries == ["I81402"] and a.topics == ["E11", "M11"]
    assert "made-up census says." in a.text and "Nets & Ropes said" in a.text  # two paragraphs
    b = rows[2287]
    assert b.byline is None and b.topics == [] and b.countries == ["USA"]
    assert rows[2288].text.strip() == ""


def test_delimited_parse(spark):
    df = delimited.read_delimited(spark, os.path.join(FIXTURES, "corpus_delimited.txt"), plain=True)
    rows = df.orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [2286, 2286, 2290, 2291]   # duplicate kept, bad lines dropped
    a = rows[0]
    assert a.byline is None and a.dateline == "MEXICO CITY" and a.text == " Body text. "
    assert a.countries == ["MEX"] and a.industries == [] and a.topics == ["E11", "M11"]
    c = rows[2]
    assert c.text == "Price $$5bn rose" and c.industries == ["I1"] and c.date is None
    assert rows[3].text == "only text" and rows[3].topics is None


def test_export_roundtrip(spark, tmp_path, corpus_of):
    c = corpus_of([(1, "line one\nline two"), (2, "has $$ inside"), (3, "")])
    path = str(tmp_path / "out")
    delimited.write_delimited(c, path, plain=True)
    back = {r.doc_id: r.text for r in delimited.read_delimited(spark, path, plain=True).collect()}
    assert back == {1: "line one line two", 2: "has $$ inside", 3: ""}


ODD = ["$", "$$", "$$$", "a$", "$a", "T$$", "\\", "\\N", "\\s", "\\\\s$", "null", "", None, "a\r\nb\nc\r", " [x, y] ", "a, b"]


def test_escaped_roundtrip_is_exact(spark, tmp_path):
    """All ten fields come back, whatever dollars, backslashes and line ends they hold."""
    import datetime

    from lodestar.schemas import CORPUS
    rows = [(i, datetime.date(1996, 8, 20) if i % 2 else None, x, ODD[i - 1], ODD[i - 2], ODD[i - 3], ODD[i - 4],
             [y for y in (x, "b") if y != ""], None if i % 3 else [], [ODD[i - 5] or None, "$"])
            for i, x in enumerate(ODD)]
    c = spark.createDataFrame(rows, CORPUS)
    path = str(tmp_path / "out")
    delimited.write_delimited(c, path)
    back = delimited.read_delimited(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect()))


def test_a_path_may_hold_a_comma(spark, tmp_path, corpus_of):
    path = str(tmp_path / "a,b")
    delimited.write_delimited(corpus_of([(1, "x")]), path)
    assert delimited.read_delimited(spark, path).count() == 1


def test_xml_roundtrip(spark, tmp_path, corpus_of):
    c = corpus_of([(1, "first paragraph\nsecond one"), (2, "AT&T <b> said")])
    path = str(tmp_path / "xml")
    news_xml.write_news_xml(c, path)
    back = {r.doc_id: r.text for r in news_xml.read_news_xml(spark, path).collect()}
    assert back == {1: "first paragraph second one", 2: "AT&T <b> said"}


def test_dedupe_is_deterministic(spark, corpus_of):
    c = corpus_of([(1, "a"), (1, "b"), (2, "c"), (2, "c")])
    out = {r.doc_id: r.text for r in dedupe_docs(c).collect()}
    assert out == {1: "b", 2: "c"}


def test_from_documents_headline(spark):
    docs = spark.createDataFrame([(7, "x" * 80 + "\nmore", "en", "s", 85)],
                                 "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    r = from_documents(docs).first()
    assert r.headline == "x" * 80 and r.title is None and r.topics == []


def test_large_xml_file_is_split(spark, tmp_path):
    """One file, many tasks; records that lie across a split are read once and whole."""
    from pyspark.sql import functions as F
    item = ('<newsitem itemid="{}" date="1996-08-20"><title>t{}</title><text>'
            + "<p>some words of a paragraph</p>" * 60 + "</text></newsitem>\n")
    bad = '<newsitem itemid="7000001" date="1996-08-20"><title>bad</titl></newsitem>\n'
    path = tmp_path / "big.xml"
    path.write_text("<newsitems>\n" + "".join(item.format(i, i) for i in range(6000)) + bad + "</newsitems>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = news_xml.read_news_xml(spark, str(path))
        assert df.rdd.getNumPartitions() > 10
        r = df.agg(F.count("*"), F.countDistinct("doc_id"), F.min(F.length("text")), F.max(F.length("text"))).first()
        assert tuple(r) == (6000, 6000, 60 * 26 - 1, 60 * 26 - 1)
        assert news_xml.news_xml_rejects(spark, str(path)).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_store_sorted_files(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("term"), F.col("id").alias("doc_id"))
    store = IndexStore(spark, str(tmp_path / "idx"))
    back = store.write("postings", df.repartition(3))
    assert back.count() == 100
    plan = back.where(F.col("term") == "3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,3)]" in plan


def test_news_xml_malformed_record_goes_to_rejects(spark):
    path = os.path.join(FIXTURES, "news_bad.xml")
    assert [r.doc_id for r in news_xml.read_news_xml(spark, path).collect()] == [5001]
    rejects = news_xml.news_xml_rejects(spark, path).collect()
    assert len(rejects) == 1 and "Broken item" in rejects[0].raw


def test_news_xml_latin1(spark, tmp_path):
    p = tmp_path / "latin1.xml"
    p.write_bytes('<?xml version="1.0" encoding="iso-8859-1" ?>\n'
                  '<newsitems><newsitem itemid="9" date="1996-08-20"><title>Café résumé</title>'
                  '<text><p>naïve</p></text></newsitem></newsitems>'.encode("iso-8859-1"))
    r = news_xml.read_news_xml(spark, str(p), encoding="ISO-8859-1").first()
    assert r.title == "Café résumé" and r.text == "naïve"


def test_news_xml_encodings_from_prologs(spark, tmp_path):
    item = '<newsitem itemid="{}" date="1996-08-20"><title>Café {}</title><text><p>naïve</p></text></newsitem>'
    files = {"a.xml": ('<?xml version="1.0" encoding="iso-8859-1" ?>\n', "iso-8859-1", [1, 2, 3]),
             "b.xml": ("<?xml version='1.0' encoding='UTF-8'?>", "utf-8", [4, 5]),
             "c.xml": ("", "utf-8", [6]),
             "d.xml": ("\ufeff<?xml version='1.0' encoding='utf8'?>", "utf-8", [7]),
             "e.xml": ("\n<?xml version='1.0'   encoding = 'Latin1' standalone='yes'?>", "iso-8859-1", [8, 9])}
    for name, (prolog, encoding, ids) in files.items():
        text = prolog + "<newsitems>" + "".join(item.format(i, i) for i in ids) + "</newsitems>"
        (tmp_path / name).write_bytes(text.encode(encoding))
    want = [(i, f"Café {i}", "naïve") for i in range(1, 10)]
    got = news_xml.read_news_xml(spark, str(tmp_path), news_xml.PROLOG).select("doc_id", "title", "text")
    assert sorted(map(tuple, got.collect())) == want
    assert news_xml.news_xml_rejects(spark, str(tmp_path), news_xml.PROLOG).count() == 0
    # more files of other encodings than may be broadcast
    joined = news_xml.news_to_corpus(news_xml._scan(spark, str(tmp_path), news_xml.PROLOG, broadcast_files=1))
    assert sorted(map(tuple, joined.select("doc_id", "title", "text").collect())) == want
    # nothing but UTF-8: the scan has no join
    plain = news_xml.read_news_xml(spark, [str(tmp_path / f"{x}.xml") for x in "bcd"], news_xml.PROLOG)
    assert "Join" not in plain._jdf.queryExecution().toString() and plain.count() == 4


def test_delimited_multi_path_and_glob(spark, tmp_path, corpus_of):
    a, b = str(tmp_path / "data" / "part-a"), str(tmp_path / "data1" / "part-b")
    delimited.write_delimited(corpus_of([(1, "one"), (2, "two")]), a)
    delimited.write_delimited(corpus_of([(3, "three")]), b)
    both = delimited.read_delimited(spark, [f"{a}/part-*", f"{b}/part-*"])
    assert sorted(r.doc_id for r in both.collect()) == [1, 2, 3]
    globbed = delimited.read_delimited(spark, [str(tmp_path / "data*" / "part-*" / "part-*")])
    assert sorted(r.doc_id for r in globbed.collect()) == [1, 2, 3]


def test_write_hits_text(spark, tmp_path):
    from lodestar.sources.results import write_hits
    hits = spark.createDataFrame([(2, 7, 1.5, "b, &amp; c"), (1, 3, 2.0, "a")],
                                 "rank INT, doc_id BIGINT, score DOUBLE, headline STRING")
    path = str(tmp_path / "hits")
    write_hits(hits, path, fmt="text")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 1
    lines = open(os.path.join(path, files[0])).read().splitlines()
    assert lines == ["(2.0,3:a)", "(1.5,7:b & c)"]


def test_store_global_order_gives_disjoint_sorted_files(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    df = spark.range(3000).select(F.concat(F.lit("t"), (F.col("id") % 211).cast("string")).alias("term"),
                                  F.col("id").alias("doc_id"))
    store = IndexStore(spark, str(tmp_path / "g"))
    store.write("postings", df.repartition(5), num_partitions=4, range_partition=True)
    ranges = []
    for f in sorted(glob.glob(str(tmp_path / "g" / "postings" / "part-*.parquet"))):
        terms = pq.read_table(f, columns=["term"]).column("term").to_pylist()
        if terms:
            assert terms == sorted(terms)
            ranges.append((terms[0], terms[-1]))
    ranges.sort()
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_left_out_lines_are_counted_and_kept_aside(spark, tmp_path):
    lines = ["1$$null$$t$$h$$null$$d$$text", "more of the text", "", "$$a$$b$$c$$d$$e$$f", "2$$too$$few",
             "99999999999999999999$$null$$t$$h$$b$$d$$x", "3$$null$$t$$h$$null$$d$$a $$ b$$[A]$$[]$$[B, C]", "12 no"]
    for i in range(2):
        (tmp_path / f"part-{i}").write_text("\n".join(lines[4 * i:4 * i + 4]) + "\n")
    rows, counts = delimited.read_delimited_checked(spark, str(tmp_path / "part-*"), str(tmp_path / "aside"), plain=True)
    assert sorted(r.doc_id for r in rows.collect()) == [1, 3]
    assert counts == {"lines": 8, "kept": 2, "rejected": 6}
    aside = {(r.value, r.reason) for r in spark.read.parquet(str(tmp_path / "aside")).collect()}
    assert aside == {("more of the text", "no id at the beginning"), ("", "empty line"),
                     ("$$a$$b$$c$$d$$e$$f", "no id at the beginning"), ("2$$too$$few", "fewer than 7 fields"),
                     ("99999999999999999999$$null$$t$$h$$b$$d$$x", "id out of range"), ("12 no", "no id at the beginning")}
    assert {r.file.rsplit("/", 1)[1] for r in spark.read.parquet(str(tmp_path / "aside")).collect()} == {"part-0", "part-1"}
