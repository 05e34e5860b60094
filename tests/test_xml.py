"""XML tables: repeated and missing elements, attributes, namespaces, nested rows, defaults, texts that can't be read."""

import pytest

from quarrylens.functions.xml import Nested, XmlColumn, faults, xml_table

TEXTS = [
    (1, '<?xml version="1.0"?><!-- c --><r xmlns:p="u"><g><p:it id="1"><nm>a</nm><tag k="x">t1</tag><tag>t2</tag><addr zip="9"><city>C&amp;D</city></addr></p:it></g><g><it id="2"><nm><![CDATA[b <x>]]></nm></it><it/></g></r>'),
    (2, "<r><other/></r>"), (3, "<s><g><it id='5'/></g></s>"), (4, "broken <"), (5, None), (6, ""), (7, "<r><g><it id='x'>plain</it></g></r>"),
]
COLUMNS = [XmlColumn("n", ordinality=True), XmlColumn("id", "int", "@id", default=-1), XmlColumn("nm", path="nm/text()"), XmlColumn("zip", "int", "addr/@zip"), XmlColumn("city", path="addr/city"), XmlColumn("own", path=".")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "k int, x string")


def test_rows_and_columns(texts):
    got = sorted(map(tuple, xml_table(texts, "x", "/r/g/p:it", COLUMNS).collect()), key=str)
    assert got == sorted([(1, 1, 1, "a", 9, "C&D", None), (1, 2, 2, "b <x>", None, None, None), (1, 3, -1, None, None, None, None), (7, 1, -1, None, None, None, "plain")], key=str)


def test_nested(texts):
    nested = Nested("tag", (XmlColumn("m", ordinality=True), XmlColumn("tag"), XmlColumn("k2", path="@k", default="-")))
    got = sorted(map(tuple, xml_table(texts, "x", "/r/g/it", COLUMNS[:2], nested).collect()), key=str)
    assert got == sorted([(1, 1, 1, 1, "t1", "x"), (1, 1, 1, 2, "t2", "-"), (1, 2, 2, None, None, None), (1, 3, -1, None, None, None), (7, 1, -1, None, None, None)], key=str)


def test_faults(texts):
    assert {(r.k, r.fault) for r in faults(texts, "x", "/r/g/it").collect()} == {(3, "root is not r"), (4, "not XML"), (6, "not XML")}
    for path in ("/r/@a", "/", "/r/it[1]"):
        with pytest.raises(ValueError):
            xml_table(texts, "x", path, COLUMNS)
