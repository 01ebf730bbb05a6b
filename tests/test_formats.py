"""The original input formats read into the operators' layouts (tiny hand-made files)."""
import math
import os

from pyspark.sql import functions as F

from quarry.operators import linkage, risk, trips
from quarry.session import shared_dir
from quarry.sources import formats


def _write(spark, name, text, fname="part-0.csv"):
    d = shared_dir(spark, name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, fname), "w", encoding="utf-8") as f:
        f.write(text)
    return d


def test_linkage_pairs_and_weights(spark):
    hdr = '"id_1","id_2",' + ",".join(f'"c{i}"' for i in range(9)) + ',"is_match"\n'
    rows = ["1,2,1,1,?,0,1,1,1,1,0,TRUE", "3,4,1,0,?,0,1,1,1,1,0,TRUE",
            "5,6,0,0,1,0,0,1,1,0,0,FALSE", hdr.strip()]
    d = _write(spark, "lk", hdr + "\n".join(rows) + "\n")
    pairs = formats.linkage_pairs(spark, d)
    assert pairs.count() == 3
    st = {(r.matched, r.pos): r for r in linkage.score_stats(pairs).collect()}
    assert st[(True, 2)].missing == 2 and st[(True, 0)].mean == 1.0 and st[(True, 1)].stdev == 0.5
    fq = _write(spark, "fq", ",".join(f'"c{i}"' for i in range(9)) + "\n" + ",".join(["0.25"] * 9) + "\n")
    freq = formats.field_frequencies(spark, fq)
    assert [(r.pos, r.field, r.u) for r in freq.orderBy("pos").collect()][:2] == [(0, "c0", 0.25), (1, "c1", 0.25)]
    w = {r.field: r for r in linkage.weights_from_scores(pairs, freq).collect()}
    assert w["c0"].m == 1.0 and w["c0"].match_ratio is None          # m = 1 -> undefined
    assert w["c1"].m == 0.5 and math.isclose(w["c1"].match_weight, math.log2(2.0))


def test_price_folder_and_fill(spark):
    a = "﻿Date,Open,High\n07-Jan-20,2.0,3\nbad,row,x\n06-Jan-20,1.0,2\n"
    d = _write(spark, "px", a, "ABC.csv")
    with open(os.path.join(d, "XYZ.csv"), "w", encoding="utf-8") as f:
        f.write("Date,Open\n08-Jan-20,5.0\n")
    q = formats.price_folder(spark, d)
    got = sorted((r.instrument, str(r.date), r.price) for r in q.collect())
    assert got == [("ABC", "2020-01-06", 1.0), ("ABC", "2020-01-07", 2.0), ("XYZ", "2020-01-08", 5.0)]
    f = risk.fill_calendar(q, "2020-01-06", "2020-01-10")
    assert f.where(F.col("instrument") == "XYZ").count() == 4


def test_taxi_csv_and_geojson(spark):
    hdr = ",".join(formats.TAXI_COLUMNS)
    rows = ["m,L1,v,1,N,2013-01-01 10:00:00,2013-01-01 10:30:00,1,1800,1.0,5,5,5,5",
            "m,L1,v,1,N,2013-01-01 11:00:00,2013-01-01 11:10:00,1,600,1.0,x,5,5,5"]
    d = _write(spark, "taxi", hdr + "\n" + "\n".join(rows) + "\n")
    t = trips.parse_trips(formats.taxi_trips(spark, d), keep=("trip_id",))
    assert sorted(r.parsefailed for r in t.collect()) == [False, True]
    gj = ('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"boroughCode":"1",'
          '"borough":"A"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]]]}}]}')
    z = formats.geojson_zones(spark, _write(spark, "gj", gj, "z.geojson"))
    out = trips.assign_zone(trips.good_rows(t), z).collect()
    assert [r.zone for r in out] == ["A"]


def test_plays_ids_aliases(spark):
    p = formats.plays(spark, _write(spark, "pl", "1 10 3\n2 11 4\n"))
    assert p.count() == 2
    n = formats.id_names(spark, _write(spark, "nm", "10\tFoo \nx\tBar\n12 NoTab\n"))
    assert [(r.id, r.name) for r in n.collect()] == [(10, "Foo")]
    a = formats.aliases(spark, _write(spark, "al", "11\t10\n\t10\n"))
    assert [(r.bad, r.good) for r in a.collect()] == [(11, 10)]


def test_articles_citations_images_network(spark):
    arts = formats.articles(spark, _write(spark, "art", '[{"title": "a", "text": "x y"},\n {"title": "b", "text": null}]',
                                         "a.json"))
    assert arts.count() == 2 and arts.select("doc_id").distinct().count() == 2
    xml = ('<MedlineCitationSet><MedlineCitation><PMID>7</PMID><MeshHeadingList>'
           '<MeshHeading><DescriptorName MajorTopicYN="Y">Heart</DescriptorName></MeshHeading>'
           '<MeshHeading><DescriptorName MajorTopicYN="N">Lung</DescriptorName></MeshHeading>'
           '<MeshHeading><DescriptorName MajorTopicYN="Y">Liver</DescriptorName></MeshHeading>'
           '</MeshHeadingList></MedlineCitation></MedlineCitationSet>')
    t = formats.citation_topics(spark, _write(spark, "cit", xml, "c.xml"))
    assert sorted((r.basket, r.topic) for r in t.collect()) == [("7", "Heart"), ("7", "Liver")]
    root = shared_dir(spark, "img")
    for cls in ("tulips", "daisy"):
        os.makedirs(os.path.join(root, cls), exist_ok=True)
        with open(os.path.join(root, cls, "x.bin"), "wb") as f:
            f.write(b"\x00\x01")
    im = formats.image_folders(spark, root, {"tulips": 1, "daisy": 0})
    assert sorted(r.label for r in im.collect()) == [0, 1]
    rec = ",".join(["0", "tcp", "http", "SF"] + ["1"] * 37 + ["normal."])
    n = formats.network_records(spark, _write(spark, "kdd", rec + "\n"))
    r = n.first()
    assert r._c1 == "tcp" and r._c0 == 0.0 and r.label == "normal." and len(n.columns) == 42


def test_whole_text_is_cut_into_elements(spark, tmp_path):
    from quarry.sources import files
    x = '<?xml version="1.0"?>\n<CSet>\n<C n="1">\n<a>x &amp; y</a></C><C/><C n="2"/><C><a/></C >\n</CSet>'
    df = spark.createDataFrame([(x,), ("",), ("<CSet/>",)], "value string")
    got = [r["e"] for r in df.select(F.explode(files.elements("value", "C")).alias("e")).collect()]
    assert got == ['<C n="1">\n<a>x &amp; y</a></C>', "<C><a/></C >"]
    df = spark.range(25).coalesce(1).selectExpr("id AS n")
    files.write_xml(df, str(tmp_path / "x"), "C", "CSet", "gzip", max_records=10)
    whole = files.read_lines(spark, str(tmp_path / "x"), whole_text=True)
    assert sorted(r["k"] for r in whole.select(F.size(files.elements("value", "C")).alias("k")).collect()) == [5, 10, 10]
    groups = df.select("n", F.explode(files.element_groups(F.array_repeat(F.lit("<C/>"), F.col("n").cast("int")), 10)).alias("g"))
    assert [r["g"].count("<C/>") for r in groups.where("n = 23").collect()] == [10, 10, 3] and groups.where("n = 0").count() == 0
