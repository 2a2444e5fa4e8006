import re

import pytest
from pyspark.sql import functions as F

from stmtscope.functions import fingerprint_text, is_balanced, norm_id, normalize_sql, qualified_name, text_id
from stmtscope.functions.comments import flat_comments
from stmtscope.schema import BATCH, RPC

NORMALIZED = [
    (
        "SELECT  *  FROM dbo.[Order 5] WHERE id = 42 AND name = N'O''Brien' -- c 1\n AND x = -3.5 AND h=0xFF "
        "AND r=1e5 AND m=$5 /* multi\nline 7 */ AND t1=@p1",
        "SELECT * FROM dbo.[Order 5] WHERE id = {##} AND name = {STR} AND x = {##} AND h={##} AND r=1e5 "
        "AND m=$5 AND t1=@p1",
    ),
    (
        "exec sp_executesql N'select * from t where id = 5',N'@p int',@p=7",
        "exec sp_executesql N'select * from t where id = 5',{STR},@p={##}",
    ),
    ("a-5 - 5", "a{##} - {##}"),
    ("SELECT \"abc 1\", 'x'", 'SELECT "abc 1", {STR}'),
    ("", ""),
    (None, ""),
    ("   \t\r\n ", ""),
    # literals next to names and to each other
    ("colN'a'5", "colN{STR}{##}"),
    ("SELECT N'a'+'b'+n'c'", "SELECT {STR}+{STR}+{STR}"),
    ("5abc", "{##}abc"),
    ("1.5 .5 5. 1.5e3 .5E-2", "{##} {##} {##} 1.5e3 .5E-2"),
    ("0x 0xAbG", "{##} {##}G"),
    ("@p1=1,#t2=2,$3.50,€9", "@p1={##},#t2={##},$3.50,€9"),
    ("a--5\n-5", "a {##}"),
    ("a/*c*/5", "a{##}"),
    ("1-/**/-2", "{##}-{##}"),
    ("a - -5", "a - {##}"),
    # quotes inside comments, comments inside quotes
    ("a -- it's\nb 'x -- y' c", "a b {STR} c"),
    ("a /* it's */ b '/* x */' c", "a b {STR} c"),
    ("['--'] [a]]'b] \"it's 5\" 'q'", "['--'] [a]]'b] \"it's 5\" {STR}"),
    ("x / 2 * 3 % 4", "x / {##} * {##} % {##}"),
    # dynamic SQL: only the next literal is kept
    ("sp_prepare @h out, N'@a int', N'select 1'", "sp_prepare @h out, N'@a int', {STR}"),
    ("exec sp_prepareX N'a 1'", "exec sp_prepareX {STR}"),
    ("exec sp_executesql_x N'a  1'", "exec sp_executesql_x N'a 1'"),
    ("exec SP_EXECUTESQL N'a 1'", "exec SP_EXECUTESQL {STR}"),
    ("exec [sp_executesql] N'a 1'", "exec [sp_executesql] {STR}"),
    ("exec sys.sp_executesql 5, 'a 1', 'b'", "exec sys.sp_executesql {##}, 'a 1', {STR}"),
    (
        "sp_executesql 'a 1','b' sp_executesql sp_prepare 'c 2','d'",
        "sp_executesql 'a 1',{STR} sp_executesql sp_prepare 'c 2',{STR}",
    ),
    ("'lead' sp_executesql 7", "{STR} sp_executesql {##}"),
    ("-- sp_executesql\n'a'", "{STR}"),
    # open ends run to the end of the text
    ("a = 'open 5", "a = {STR}"),
    ("a = 'x''open 5", "a = {STR}"),
    ("a [open 5", "a [open 5"),
    ("a /* open 5", "a"),
    ("5 -- 'open", "{##}"),
    # block comments nest
    ("a /* b /* c */ d */ e", "a e"),
    ("a /*/* 1 */ 'x */ b 'y' 2", "a b {STR} {##}"),
    ("a /*/*/ b */*/ c */*d*/ 1", "a c * {##}"),
    ("a /* /* b */ 'open 5", "a"),
    ("a /* it's /* \" [ */ */ 'b' [c /* /* ]] /* ] 5", "a {STR} [c /* /* ]] /* ] {##}"),
    ("'/* /* ' + 1 -- /* /* '\n+ 'x' \"/* /*\"", "{STR} + {##} + {STR} \"/* /*\""),
    ("sp_executesql N'/* /* */ 1' /* /* */ */, 'b'", "sp_executesql N'/* /* */ 1' , {STR}"),
    ("1/*/**/*/2 a/*/**/*/3", "{##}{##} a{##}"),
    # Unicode names and spaces
    ("été1 = 1", "été1 = {##}"),
    ("a 　b c\u0085d", "a b c d"),
    ("N", "N"),
    ("N N'x'", "N {STR}"),
]


def test_normalize_sql(spark):
    rows = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(NORMALIZED)], "i int, text string"
    )
    got = dict(rows.select("i", normalize_sql(F.col("text"))).collect())
    assert {i: got[i] for i in got} == {i: want for i, (_, want) in enumerate(NORMALIZED)}


def test_very_long_statements(spark):
    """Long literals, lists and comments: linear, and no stack growth."""
    n = 200_000
    texts = {
        "literal": ("x = '" + "a''b" * n + "'", "x = {STR}"),
        "list": ("x in (" + "1," * n + "2)", "x in (" + "{##}," * n + "{##})"),
        "names": ("ab. " * n + "5", "ab. " * n + "{##}"),
        "calls": ("sp_executesql " * n + "'a'", "sp_executesql " * n + "'a'"),
        "no_statement": ("sp_executesql " * n + "5", "sp_executesql " * n + "{##}"),
        "comment": ("/*" + "* / " * n + "*/ 5", "{##}"),
        "open": ("'a' " * n + "'", "{STR} " * n + "{STR}"),
        "signs": ("-/." * n, "-/." * n),
        "deep": ("a " + "/*" * n + "x" + "*/" * n + " 5", "a {##}"),
        "never_closed": ("a " + "/* ' " * n + "*/ " * (n - 1) + "5", "a"),
        "many": ("/*/* a */*/ 'x' " * n, " ".join(["{STR}"] * n)),
    }
    rows = spark.createDataFrame([(k, v[0]) for k, v in texts.items()], "k string, text string")
    got = dict(rows.select("k", normalize_sql(F.col("text"))).collect())
    for k, (_, want) in texts.items():
        assert got[k] == want, k


BALANCE = {
    "a 'b' [c]]d] \"e\" /* f /* g */ */ -- it's": True,
    "": True,
    "a 'open": False,
    "a 'x''open": False,
    "a [b]] open": False,
    'a "b': False,
    "a /* b /* c */ d": False,
    "a /* b /* c */ d */": True,
    "a /* b": False,
    "a */ ] b": True,
    "N'x' - / . --'": True,
    "'-- /* ' [/*] 1 / 2 - 3": True,
}


def test_unbalanced_statements_give_no_text(spark):
    rows = spark.createDataFrame([(t,) for t in BALANCE], "text string")
    got = rows.select("text", is_balanced(F.col("text")), normalize_sql(F.col("text"), reject_unbalanced=True)).collect()
    assert {t: ok for t, ok, _ in got} == BALANCE
    assert all((norm != "") == (BALANCE[t] and t != "") for t, _, norm in got)
    assert rows.select(is_balanced(F.lit(None).cast("string"))).first()[0] is True


@pytest.mark.parametrize(
    "text, name, want",
    [
        ("exec dbo.MyProc @a=1", "MyProc", "dbo.MyProc"),
        ("exec dbo.MyProc", "MyProc", "MyProc"),
        ("MyProc", "MyProc", "MyProc"),
        ("exec  [x].MyProc  @a", "MyProc", "[x].MyProc"),
        ("MyProc @a = 1", "MyProc", ""),
        ("exec a b.MyProc", "MyProc", ""),
        ("exec foo @a=1", "MyProc", ""),
        ("exec dbo.P @a=1", "", ""),
        ("exec \n[x].MyProc\t @a", "MyProc", "[x].MyProc"),
        ("", "MyProc", "MyProc"),
        (None, None, ""),
    ],
)
def test_qualified_name(spark, text, name, want):
    row = spark.createDataFrame([(text, name)], "text string, name string")
    assert row.select(qualified_name(F.col("text"), F.col("name"))).first()[0] == want


@pytest.mark.parametrize(
    "event_type, name, text, plain, captured",
    [
        (BATCH, None, "select 1", "select {##}", "select {##}"),
        (RPC, "sp_executesql", "exec sp_executesql N'a 1', 2", "exec sp_executesql N'a 1', {##}", None),
        (RPC, "sp_execute", "exec sp_execute 5", "exec sp_execute {##}", None),
        (RPC, "sp_prepare", "sp_prepare 5", "sp_prepare {##}", None),
        (RPC, "sp_prepexec", "exec sys.sp_prepexec 5", "sp_prepexec", "sys.sp_prepexec"),
        (RPC, "MyProc", "exec dbo.MyProc @a=1", "MyProc", "dbo.MyProc"),
        (RPC, None, "exec dbo.MyProc @a=1", "", ""),
    ],
)
def test_fingerprint_route(spark, event_type, name, text, plain, captured):
    row = spark.createDataFrame([(event_type, name, text)], "e string, n string, t string")
    cols = [F.col("e"), F.col("n"), F.col("t")]
    assert row.select(fingerprint_text(*cols)).first()[0] == plain
    want = plain if captured is None else captured
    assert row.select(fingerprint_text(*cols, capture_schema_name=True)).first()[0] == want


def test_ids_are_stable(spark):
    import hashlib

    row = spark.createDataFrame([("db", "select {##}")], "db string, norm string")
    got = row.select(norm_id(F.col("db"), F.col("norm")), text_id(F.col("norm"))).first()
    want = [int(hashlib.md5(s.encode()).hexdigest()[:15], 16) for s in ("db, select {##}", "select {##}")]
    assert list(got) == want


def test_normaliser_is_code_generated(spark, tmp_path, capsys):
    """No Python worker, and no interpreted fold in the stage of the rewrites."""
    spark.range(3).select(F.col("id").cast("string").alias("t")).write.parquet(str(tmp_path / "t"))
    flat = spark.read.parquet(str(tmp_path / "t")).withColumn("flat", flat_comments(F.col("t")))
    flat.select(normalize_sql(F.col("t"), flat=F.col("flat"))).explain()
    plan = capsys.readouterr().out.splitlines()
    assert not any("Python" in line for line in plan)
    rewrites = next(line for line in plan if "{##}" in line)
    assert re.match(r"(\+- )?\*\(\d+\) Project", rewrites) and "aggregate(" not in rewrites
    assert any("aggregate(" in line for line in plan)
