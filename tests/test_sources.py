import json
import os
import subprocess
import sys
import zipfile

from pyspark.sql import functions as F

from siftgrade.operators import rules
from siftgrade.plans import catalog
from siftgrade.sources import artifacts, chat, xlsx
from siftgrade.streaming import classify as stream

HEAD = '<?xml version="1.0"?>'
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, rows):
    """A minimal workbook: first column as shared strings, others inline or numbers."""
    shared = [r[0] for r in rows]
    body = ""
    for i, r in enumerate(rows, 1):
        cells = f'<c r="A{i}" t="s"><v>{i - 1}</v></c>'
        for j, v in enumerate(r[1:], 1):
            if v is not None:
                ref = f"{chr(65 + j)}{i}"
                cells += f'<c r="{ref}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        body += f'<row r="{i}">{cells}</row>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'{HEAD}<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="t" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"{HEAD}<sst {MAIN}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"{HEAD}<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    workbook(tmp_path / "a.xlsx", [("title", None, None), ("字段名", "字段注释", "n"), ("phone", None, 5)])
    workbook(tmp_path / "sub" / "b.xlsx", [("字段名", "字段注释", "字段名"), ("tel", "电话", "again")])
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    rows = xlsx.read_workbooks(spark, str(tmp_path))
    assert rows.count() == 5 and rows.where("row_no = 3").first().cells == ["phone", None, "5"]
    got = {os.path.basename(r.path): r.fields for r in xlsx.with_header(rows, ["字段名", "字段注释"]).collect()}
    assert got == {"a.xlsx": {"字段名": "phone", "字段注释": None, "n": "5"}, "b.xlsx": {"字段注释": "电话", "字段名": "again"}}


def test_artifacts(spark, tmp_path, monkeypatch):
    (tmp_path / "x.taxonomy.json").write_text('{"domain": "d",\n "tree": [1]}')
    (tmp_path / "y.taxonomy.json").write_text("{broken")
    (tmp_path / "z.seeds.json").write_text('{"domain": "no"}')
    (tmp_path / "g.PDF").write_bytes(b"line one\nline two")
    (tmp_path / "r.csv").write_text("FieldName,Category,Level,PatternKeywords,PatternRegex,Citation,Source,Priority\nf,c,S1,k,,,,\n")
    assert [r.domain for r in artifacts.read_json(spark, str(tmp_path), ".taxonomy.json", "domain string").collect()] == ["d"]
    files = artifacts.guides(spark, str(tmp_path))
    assert [(r.name, r.extension) for r in files.collect()] == [("g", "pdf")]
    frags = artifacts.fragments_of(files, lambda content: [{"page": 1, "type": "paragraph", "text": t} for t in content.decode().split("\n")])
    assert [r.text for r in frags.orderBy("ord").collect()] == ["line one", "line two"]
    assert artifacts.fragments_of(files, lambda content: 1 / 0).count() == 0
    assert artifacts.dynamic_rules(spark, str(tmp_path)).first().Priority == 60
    gen = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    rev = spark.createDataFrame([("b", "9"), ("a", None)], "k string, v string")
    assert sorted(map(tuple, artifacts.overridden(gen, rev, ["k"], "v").collect())) == [("a", "1"), ("b", "9")]
    out = str(tmp_path / "out")
    artifacts.write_json(gen, out, "k")
    assert spark.read.json(out).count() == 2
    gen.withColumnRenamed("k", "domain").write.partitionBy("domain").parquet(str(tmp_path / "p"))
    assert artifacts.domains(spark, str(tmp_path / "p"), "b").count() == 1
    made = rules.rules_json(*rules.rule_tables(spark.createDataFrame(catalog.CATALOG_ITEMS, catalog._ITEM)))
    artifacts.write_rules(made, str(tmp_path / "rules"))
    assert all("conditions" in json.loads(r.value) for r in spark.read.text(str(tmp_path / "rules")).collect())
    artifacts.write_report({"one": gen}, str(tmp_path / "report"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "report" / "one")).count() == 2
    monkeypatch.setenv("CFG", str(tmp_path / "cfg.json"))
    assert artifacts.load_config("CFG", None, {"a": 1}) == {"a": 1}
    (tmp_path / "cfg.json").write_text('{"a": 2}')
    assert artifacts.load_config("CFG", None, {"a": 1, "b": 3}) == {"a": 2, "b": 3}


def test_chat(spark):
    def client(turns):
        text = turns[-1]["content"]
        if "fail" in text:
            raise chat.TooManyRequests("slow down")
        return f'Sure: {{"n": {len(turns)}}} done' if "json" in text else "nothing"

    df = spark.createDataFrame([(1, "json"), (2, "fail"), (3, "other")], "k int, q string")
    asked = df.select("k", chat.messages("be brief", F.col("q"), [("q", "a")]).alias("messages"))
    got = {r.k: r for r in chat.parsed(chat.chat(asked, "k", client, attempts=2, backoff=0.01), "n int").collect()}
    assert got[1].parsed.n == 4 and got[1].error is None
    assert got[2].reply is None and got[2].error == "slow down"
    assert got[3].error == "no JSON object in the reply"
    assert json.loads(df.select(chat.extraction_payload(F.lit("d"), F.array("q"), F.array("q")).alias("p")).first().p)["domain"] == "d"


def test_stream_equals_batch(spark, tmp_path):
    cols = "row_id long, tablename string, `字段名` string, `字段注释` string, `字段样本` string"
    df = spark.createDataFrame([(1, "t", "pond_coord", None, None), (2, "t", "x", "金额", "12.50"), (3, None, None, None, None)], cols)
    df.write.parquet(str(tmp_path / "xlsx_catalog.parquet"))
    a = stream.stream_classify(spark, str(tmp_path)).orderBy("row_id").collect()
    assert a == catalog.classify_catalog(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [r.confidence for r in a] == ["medium", "high", "low"]


def test_the_rest_works_without_llm():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['siftgrade.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p1_found' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=here, check=True)


def test_written_workbooks_come_back(spark, tmp_path):
    cells = [["字段名", "b&<", None, "x"], [" a\n\tb ", "", "\x01\r\n", "😀" * 3], [None, None, "z"]]
    df = spark.createDataFrame([(b, i, r) for b in ("one", "two") for i, r in enumerate(cells, 1)], "book string, row_no int, cells array<string>")
    for _ in range(2):  # a task that runs again writes the same
        assert {r.book: r.n_rows for r in xlsx.write_workbooks(df, str(tmp_path / "w")).collect()} == {"one": 3, "two": 3}
    got = {(os.path.basename(r.path), r.row_no): r.cells for r in xlsx.read_workbooks(spark, str(tmp_path / "w")).collect()}
    assert sorted(os.listdir(tmp_path / "w")) == ["one.xlsx", "two.xlsx"]
    assert got["one.xlsx", 1] == ["字段名", "b&<", None, "x"] and got["two.xlsx", 3] == [None, None, "z"]
    assert got["one.xlsx", 2] == [" a\n\tb ", None, "\r\n", "😀😀😀"] or got["one.xlsx", 2][0] == " a\n\tb "
    assert [xlsx._letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert xlsx.write_workbooks(df.limit(0), str(tmp_path / "none")).count() == 0


def test_configurations(spark, tmp_path, monkeypatch):
    assert artifacts.config(spark, "params")["batch_size"] == 20
    (tmp_path / "k.json").write_text('{"generic": ["a", "b"], "domain_extra": {"d": ["b", "c"]}}')
    spark.conf.set("siftgrade.config.keywords", str(tmp_path / "k.json"))
    words = artifacts.keywords_of(artifacts.config(spark, "keywords"), F.col("d"))
    got = spark.createDataFrame([("d",), ("x",), (None,)], "d string").select(words.alias("w")).collect()
    assert [r.w for r in got] == [["a", "b", "c"], ["a", "b"], ["a", "b"]]
    spark.conf.unset("siftgrade.config.keywords")
    monkeypatch.setenv("SIFTGRADE_PARAMS", str(tmp_path / "p.json"))
    (tmp_path / "p.json").write_text('{"batch_size": 7}')
    assert artifacts.config(spark, "params") == artifacts.CONFIGS["params"] | {"batch_size": 7}
