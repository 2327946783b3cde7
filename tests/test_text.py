from pyspark.sql import functions as F

from benchloom.functions import text, xml


def value(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_strip_trims_what_python_trims(one):
    for sample in ["　 a b\x1f\n", "\x85x ", "", " \t", "​z"]:
        assert value(one(s=sample), text.strip(F.col("s"))) == sample.strip()


def test_lines_split_at_newline_only(one):
    sample = "a\r\nb c\n\n"
    assert value(one(s=sample), text.lines(F.col("s"))) == sample.split("\n")


def test_with_next(one):
    rows = value(one(s="a\nb"), text.with_next(text.lines(F.col("s"))))
    assert [tuple(r) for r in rows] == [("a", "b"), ("b", None)]


def test_from_line_with(one):
    assert value(one(s="x\nfoo MARK bar\nend MARK"), text.from_line_with(F.col("s"), "MARK")) == "foo MARK bar\nend MARK"
    assert value(one(s="MARK"), text.from_line_with(F.col("s"), "MARK")) == "MARK"
    assert value(one(s="none"), text.from_line_with(F.col("s"), "MARK")) == ""


def test_unescape(one):
    sample = "&lt;a&gt; &quot;&apos; &amp; &#10;&#x41;&#128512;"
    assert value(one(s=sample), xml.unescape(F.col("s"))) == "<a> \"' & \nA\U0001f600"


def test_escape_and_unescape_are_inverse(one):
    sample = 'a<b> & "c"'
    assert value(one(s=sample), xml.unescape(xml.escape(F.col("s")))) == sample


def test_attribute(one):
    tag = """<t other="x" name='a "q"' message="1 &gt; 0">"""
    assert value(one(s=tag), xml.attribute(F.col("s"), "name")) == 'a "q"'
    assert value(one(s=tag), xml.attribute(F.col("s"), "message")) == "1 > 0"
    assert value(one(s=tag), xml.attribute(F.col("s"), "type")) is None
    assert value(one(s='<t name="">'), xml.attribute(F.col("s"), "name")) == ""
