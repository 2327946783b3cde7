import pytest
from pyspark.sql import functions as F

from benchloom.operators import patches


def section(path, body="@@", target=None):
    return f"diff --git a/{path} b/{target or path}\n{body}"


def files(one, diff, **kw):
    got = patches.diff_files(one(id="x", full_patch=diff), **kw).orderBy("position").collect()
    return [(r.file, r.diff) for r in got]


def test_text_before_the_first_header_is_dropped(one):
    first, second = section("src/x.py", "+1"), section("tests/y.py", "+2\n")
    assert files(one, f"junk\n{first}\n{second}") == [("src/x.py", first), ("tests/y.py", second)]
    assert files(one, "no diff at all") == []


def test_path_loses_all_leading_a_and_slash(one):
    diff = section("api/x.py")
    assert files(one, diff)[0][0] == "pi/x.py"
    assert files(one, diff, strict=True)[0][0] == "api/x.py"
    assert files(one, section("aa")) == []  # nothing is left of the path


def test_short_header_drops_its_lines(one):
    assert files(one, f"{section('x.py')}\ndiff --git broken\n+lost\n{section('y.py')}") == [
        ("x.py", section("x.py")), ("y.py", section("y.py"))]


def test_last_diff_of_a_file_counts_at_the_first_place(one):
    diff = "\n".join([section("x", "1"), section("y", "2"), section("x", "3"), section("z", "4")])
    assert files(one, diff) == [("x", section("x", "3")), ("y", section("y", "2")), ("z", section("z", "4"))]


@pytest.mark.parametrize("path, is_test", [
    ("tests/a.c", True), ("src/test/B.java", True), ("pkg/test_x.py", True), ("pkg/x_test.py", True),
    ("contest/run.c", True), ("test_x.pyc", False), ("src/latest.py", False),
])
def test_test_paths(one, path, is_test):
    row = patches.split_test_patch(one(full_patch=section(path))).first()
    assert (row.test_patch, row.patch) == ((section(path), "") if is_test else ("", section(path)))


def test_own_pattern(one):
    row = patches.split_test_patch(one(full_patch=section("spec/x.rb")), pattern=r"^spec/").first()
    assert row.patch == "" and row.test_patch


def test_gold_patch_looks_at_the_whole_header_and_keeps_line_ends(one):
    a, b, c = section("latest_x.py", "+1\r\n"), section("src/x.py", "+2\n"), section("src/x.py", "+3")
    row = patches.gold_test_patch(one(full_patch=f"junk\n{a}{b}{c}")).first()
    assert row.test_patch == a and row.gold_patch == b + c


def test_gold_patch_knows_every_line_end(one):
    diff = "diff --git a/x b/x\r+1 diff --git a/tests/y b/y\x0c+2"
    row = patches.patch_dict(one(full_patch=diff)).first()
    assert row.gold_patch == "diff --git a/x b/x\r+1 "
    assert row.test_patch == "diff --git a/tests/y b/y\x0c+2"
    assert row.full_path == diff


def test_applicability(spark):
    df = spark.createDataFrame([(None,), (" \n",), ("+x",), ("diff --git a b",)], "p STRING")
    got = [r[0] for r in df.select(patches.patch_applicability(F.col("p"))).collect()]
    assert got == ["empty", "empty", "not_a_diff", "apply"]


def test_capped_diff(one):
    two = f"{section('x')}\n{section('y')}"
    got = one(d=two).select(patches.capped_diff(F.col("d"), 1), patches.capped_diff(F.col("d"), 2)).first()
    assert got[0] is None and got[1] == two + "\n"


def test_splice(one):
    df = one(content="a\nb\nc", left_context="a", gt="X", right_context="c\n\n")
    assert patches.splice_candidate(df).first().spliced == "a\nX\nc"
    java = one(content="a\nb\nc", left_context="a\n", gt="X", right_context="\nc")
    assert patches.splice_candidate(java, dialect="java").first().spliced == "a\nX\nc"
    wrong = one(content="a\nb\nc", left_context="z", gt="X", right_context="c")
    assert patches.splice_candidate(wrong).first().is_valid is False


def repaired(one, test, source):
    return patches.java_test_repair(one(test_code=test, source_code=source)).first().repaired


def test_java_repair(one):
    source = "package com.a;\nimport x.Y;\nimport static x.Z;\nclass A {}"
    assert repaired(one, "ckage old;\nimport x.Z;\nclass T {}", source) == (
        "package com.a;\nimport x.Y;\nimport x.Z;\nclass T {}")
    assert repaired(one, "<|code|>class T {}", source) == (
        "package com.a;\nimport x.Y;\nimport static x.Z;\nclass T {}")
    assert repaired(one, "class T {}", "import x.Y;\nclass A {}") == "import x.Y;\nclass T {}"
    assert repaired(one, None, "class A {}") == ""
    assert repaired(one, "package b;\npackage c;\nclass T {}", "package a;") == "package a;\npackage a;\nclass T {}"


@pytest.mark.parametrize("answer, code", [
    ("Here:\n```java\nclass T {}\n```\nbye", "class T {}"),
    ("```\nclass T {}\n```", "class T {}"),
    ("class T {}", "class T {}"),
    ("```python\nx\n```\n```java\nclass T {}\n```", "class T {}"),
    ("", ""),
    ("open ```java\nclass T {}", "class T {}"),
    ("one ``` only", "one ``` only"),
])
def test_fenced_code(one, answer, code):
    assert one(a=answer).select(patches.fenced_code(F.col("a"))).first()[0] == code


@pytest.mark.parametrize("code, indent", [
    ("return 1", 0), ("    return 1", 4), ("        x\n  y", 8), ("\n\n    x", 4), ("   \n\t\n", 0), ("\t  x", 3), ("", 0),
])
def test_stub_indentation(one, code, indent):
    row = patches.stub_codes(one(gt=code)).first()
    assert row.return_pass == " " * indent + "pass"
    assert row.return_empty_str == " " * indent + 'return ""'
