import json
import sys

from pyspark.sql import functions as F

from sedimenta.operators import extract, generate, names, report, sections
from sedimenta.sources import calls, tables
from sedimenta.streaming.incremental import dedup_stream

from .conftest import rows

PROSE = "The page explains how records are posted in one step. It also says what happens when a line is blocked, and how to unblock it again before the next run."


def test_sections_and_questions(spark):
    page = f"---\ntitle: 'Guide'\n---\n# Guide\n\nIntro.\n\n## Post records (AL)\n\n{PROSE}\n\n### See also\n\n- [a](b)\n\n## Links\n\n- [a](b)\n- [c](d)\n\n## Why?\n{PROSE}\n"
    ref = f"# Foo Method\n\n{PROSE}\n\n## See also\n\nlinks"
    old = f"# Bar Property\n\nThis is deprecated. {PROSE}"
    df = spark.createDataFrame([(1, page), (2, ref), (3, old), (4, None), (5, ""), (6, "plain")], "id long, text string")
    s = rows(sections.sections(df, "id", "text"), "id", "level", "heading")
    assert [x for x in s if x[0] == 1] == [(1, 2, "Links"), (1, 2, "Post records (AL)"), (1, 2, "Why?"), (1, 3, "See also")]
    q = {(r.id, r.question) for r in sections.page_questions(df, "id", "text").collect()}
    assert q == {(1, "In AL, explain Post records."), (1, "Why?"), (2, "How do I use the `Foo` method in AL? What does it do?")}
    t = [r[0] for r in df.select(sections.front_title(F.col("text"))).collect()]
    assert t[0] == "Guide" and t[1] is None


def test_prose_ratio(spark):
    df = spark.createDataFrame([("a\n- [x](y)\n```\ncode\n```\n| t |\nb",), ("",)], "t string")
    assert [r[0] for r in df.select(sections.prose_ratio(F.col("t"))).collect()] == [0.5, 0.0]


def test_diagnostics(spark):
    log = "x\nsrc\\A.al(3,7): error AL0118: The name 'X' does not exist\r\nsrc/A.al(9,1): warning AA0021: order\nnoise(1): y"
    df = spark.createDataFrame([(1, log), (2, None)], "id long, log string")
    got = rows(extract.parse_diagnostics(df, "log", "id"), "path", "line", "code", "severity")
    assert got == [("src/A.al", 3, "AL0118", "error"), ("src/A.al", 9, "AA0021", "warning")]


def test_interval_join_shared_borders_and_long_spans(spark):
    d = spark.createDataFrame([("p", 1), ("p", 10), ("p", 11), ("p", 500), ("q", 1)], "path string, line int")
    s = spark.createDataFrame([("a", "p", 0, 9), ("b", "p", 9, 9), ("c", "p", 5, 900), ("d", "p", 9, 3)], "owner string, path string, start_row int, end_row int")
    want = sorted((o, line) for p, line in [("p", 1), ("p", 10), ("p", 11), ("p", 500)] for o, _, a, b in [("a", "p", 0, 9), ("b", "p", 9, 9), ("c", "p", 5, 900)] if a <= line - 1 <= b)
    assert rows(extract.attribute(d, s), "owner", "line") == want


def test_reports(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a"), ("j", "c")], "g string, c string")
    assert rows(report.mode(df, ["g"], "c")) == [("j", "c", 1), ("k", "a", 2)]
    assert rows(report.top_k(df, ["g"], "c", 1)) == [("j", "c", 1, 1), ("k", "a", 2, 1)]
    one = spark.createDataFrame([("X", "first"), ("Y", "first")], "code string, m string")
    two = spark.createDataFrame([("X", "second"), ("Z", "second")], "code string, m string")
    assert rows(report.merged_by_priority([one, two], "code"), "code", "m") == [("X", "first"), ("Y", "first"), ("Z", "second")]
    cat = spark.createDataFrame([("AL0001", "ERR_SemicolonExpected"), ("AL0002", "ERR_NameNotFound"), ("AA0001", None), ("AL0003", "ERR_Foo")], "c string, n string")
    assert [r[0] for r in cat.select(report.diagnostic_category(F.col("c"), F.col("n"))).collect()] == ["syntax", "binding", "analyzer-style", "semantic"]
    assert "| a | 2 |" in report.markdown_table(report.mode(df, ["g"], "c").where("g = 'k'").select("c", "n"))


def test_nearest_names(spark):
    bad = spark.createDataFrame([("Postt",), ("Zzz",), ("Amb",), (None,)], "n string")
    pool = spark.createDataFrame([("Post",), ("POST",), ("Ama",), ("Amc",), (None,)], "n string")
    assert rows(names.nearest_names(bad, pool)) == [("Postt", "POST")]


def test_hallucination_class_takes_first_known_code(spark):
    df = spark.createDataFrame([(["AL9999", "AL0432", "AL0118"],), (["AL9999"],), ([],)], "c array<string>")
    assert [r[0] for r in df.select(generate.hallucination_class(F.col("c"))).collect()] == ["OBJECT", "OTHER", "OTHER"]


def test_jsonl_dead_letters(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    good = {"gen": "g1", "target_al": "x", "messages": [{"role": "user", "content": "ü"}], "meta": {"repo": "r"}}
    p.write_text(json.dumps(good) + "\n\n{broken\n" + json.dumps({"_parse_error": "boom", "path": "p"}) + "\n")
    ok, bad = tables.read_jsonl(spark, str(p), tables.CANDIDATE)
    assert rows(ok, "gen", "meta.repo") == [("g1", "r")] and sorted(r.error for r in bad.collect()) == ["boom", "{broken"]
    tables.write_jsonl(ok, str(tmp_path / "out"))
    again, none = tables.read_jsonl(spark, str(tmp_path / "out"), tables.CANDIDATE)
    assert again.first().messages[0].content == "ü" and none.count() == 0


def test_tsv_and_trees(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\tc\td\n\nx\n")
    assert rows(tables.read_tsv(spark, str(tmp_path / "t.tsv"), 3)) == [("a", "b", "c"), ("x", "", "")]
    (tmp_path / "r/App/.alpackages").mkdir(parents=True)
    (tmp_path / "r/App/app.json").write_text("{}")
    (tmp_path / "r/App/x.al").write_bytes(b"codeunit 1 X { } // \xff")
    tree = tables.read_tree(spark, str(tmp_path / "r"))
    assert rows(tree, "path") == [("App/x.al",)] and tree.first().content.startswith("codeunit")
    found = spark.createDataFrame([("App/app.json",), ("App/.alpackages/app.json",), ("app.json",), ("Xapp.json",)], "p string")
    assert rows(tables.app_folders(found)) == [("",), ("App",)]


def test_calls_keep_order_and_errors():
    def call(x):
        if x == 2:
            raise ValueError("no")
        return x * 10

    assert calls.in_order(call, [1, 2, 3]) == [(10, None), (None, "ValueError: no"), (30, None)]


def test_only_passing_failures_are_tried_again():
    tried = []

    class Failure(Exception):
        def __init__(self, status):
            self.status = status

    def call(x):
        tried.append(x)
        if tried.count(x) == 1:
            raise {1: TimeoutError("slow"), 2: Failure(503), 3: Failure(404), 4: ValueError("no")}[x]
        return x

    assert [e is None for _, e in calls.in_order(call, [1, 2, 3, 4], workers=1)] == [True, True, False, False] and tried == [1, 1, 2, 2, 3, 4]


SERVER = """
import sys, json
i, o = sys.stdin.buffer, sys.stdout.buffer
def put(**m):
    b = json.dumps(dict(jsonrpc="2.0", **m)).encode(); o.write(b"Content-Length: %d\\r\\n\\r\\n" % len(b) + b); o.flush()
while True:
    h = i.readline()
    if not h: break
    if not h.lower().startswith(b"content-length"): continue
    n = int(h.split(b":")[1]); i.readline(); m = json.loads(i.read(n)); p = m.get("params", {})
    if m["method"] in ("textDocument/didOpen", "textDocument/didChange"):
        d = [dict(code=dict(value="AL0118"), severity=1, range=dict(start=dict(line=0, character=2)), message="x")] if "bad" in p["textDocument"]["text"] else []
        put(method="textDocument/publishDiagnostics", params=dict(uri=p["textDocument"]["uri"], diagnostics=d))
    elif m["method"] == "textDocument/completion": put(id=m["id"], result=dict(items=[dict(label="Post")]))
    elif m["method"] == "tools/call":
        t = p["name"]
        if t == "list_rules": put(id=m["id"], result=dict(content=[dict(type="text", text="no json")], isError=True))
        else: put(id=m["id"], result=dict(content=[dict(type="text", text=json.dumps(dict(diagnostics=[dict(id="FC1", line=3, column=4, severity="Warning", filePath="a\\\\b.al", message=t)])))]))
    elif "id" in m: put(id=m["id"], result={})
"""


def test_tool_servers_and_detected_framing(tmp_path):
    from sedimenta.sources import servers

    start = lambda: calls.ProcessClient([sys.executable, "-c", SERVER], framing="auto", patience=1.0)
    fixes = servers.FixServer(start())
    assert fixes.client.framing == "headers"
    assert fixes.analyze("p") == [{"file": "a/b.al", "line": 3, "column": 4, "severity": "warning", "code": "FC1", "message": "analyze"}]
    assert servers.CompileServer(start()).compile("p")[0]["message"] == "al_compile"
    try:
        fixes.list_rules()
        raise AssertionError
    except RuntimeError as e:
        assert str(e) == "no json"
    fixes.client.close()
    f = tmp_path / "x.al"
    f.write_text("bad text")
    lsp = servers.LanguageServer(start(), str(tmp_path))
    assert lsp.error_codes(str(f)) == ["AL0118"] and lsp.diagnostics(str(f))[0]["column"] == 3
    assert lsp.is_error_clean(str(f), "good text") and lsp.completion(str(f), 1, 1) == ["Post"]


def test_coercion_of_results():
    from sedimenta.sources import servers as v

    assert [v.code_of(d) for d in ({"code": 7}, {"code": {"value": "A"}}, {"id": "B"}, {"code": None}, {})] == ["7", "A", "B", "", ""]
    assert [v.severity_of(d) for d in ({"severity": 2}, {"severity": "3"}, {"severity": "Error"}, {"severity": None}, {}, {"severity": 9})] == ["warning", "info", "error", "error", "error", "error"]
    assert v.range_of({"startLine": "4", "startColumn": 2}) == (4, 2) and v.range_of({}) == (1, 1) and v.range_of({"range": {"start": {"line": 0, "character": 0}}}) == (1, 1)
    assert v.file_of({"uri": "file:///a%20b/c.al"}) == "/a b/c.al" and v.file_of({}) == ""


def test_diagnostics_without_a_position(spark):
    df = spark.createDataFrame([("r", "x.al(1,2): error AL0118: no name\nerror AL1022: no package\r\nplain\nwarning AA1: short"), ("s", None)], "repo string, log string")
    assert rows(extract.parse_loose(df, "log", "repo")) == [("r", "error", "AL0118", "no name"), ("r", "error", "AL1022", "no package")]


def test_process_client_both_framings(tmp_path):
    lines = "import sys,json\nfor l in sys.stdin:\n    m=json.loads(l)\n    print(json.dumps({'method':'note'}),flush=True)\n    print(json.dumps({'id':m['id'],'result':m['params']}),flush=True)\n"
    c = calls.ProcessClient([sys.executable, "-c", lines])
    assert c.request("echo", {"a": 1}) == {"a": 1} and c.request("echo", {"a": 2}) == {"a": 2}
    c.close()
    headers = (
        "import sys,json\ni,o=sys.stdin.buffer,sys.stdout.buffer\nwhile True:\n    h=i.readline()\n    if not h: break\n    n=int(h.split(b':')[1]); i.readline(); m=json.loads(i.read(n))\n"
        "    b=json.dumps({'id':m['id'],'error':{'message':'bad'}}).encode(); o.write(b'Content-Length: %d\\r\\n\\r\\n'%len(b)+b); o.flush()\n"
    )
    c = calls.client([sys.executable, "-c", headers], "headers")
    try:
        c.request("x")
        raise AssertionError
    except RuntimeError as e:
        assert str(e) == "bad"
    c.close()


def test_incremental_dedup(spark, tmp_path):
    schema = "id long, t string"
    inbox, sink, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], schema).write.parquet(inbox)
    run = lambda: dedup_stream(spark, inbox, schema, "t", sink, cp, order="id")
    run()
    assert rows(spark.read.parquet(sink), "id") == [(1,), (3,)]
    spark.createDataFrame([(4, "b"), (5, "c"), (6, None)], schema).write.mode("append").parquet(inbox)
    run()
    run()
    assert rows(spark.read.parquet(sink), "id") == [(1,), (3,), (5,), (6,)]


def test_paths_of_teaching_pages(spark):
    paths = ["dev-itpro/developer/methods.md", "dev-itpro/administration/telemetry-x.md", "dev-itpro/upgrade/x.md", "developer", "docs\\developer\\a\\b.md", "docs/developer/Includes/x.md", "docs/developer/monitoring.md", "docs/x/developer/y.md", None, ""]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    assert [r[0] for r in df.orderBy("i").select(sections.path_teaches(F.col("p"))).collect()] == [True, False, False, True, True, False, False, False, False, False]


def test_catalogue_of_codes(spark):
    data = [
        ("AL0001", "error", "ERR_InvalidLiteral", None), ("AL0002", "warning", "WRN_ObsoleteThing", None), ("AL0003", "error", "ERR_DuplicateFieldId", None), ("AL0004", "error", "ERR_NoSuchMember", None), ("AL0005", "error", "ERR_OrphanedElse", None),
        ("AL0006", "info", "INF_Whatever", None), ("AL0007", "warning", "WRN_Whatever", None), ("AL0008", "error", "ERR_Whatever", None), ("AL0009", None, None, None), ("AL0010", "error", "ERR_TypeMismatch", None), ("AL0011", "error", "ERR_ManifestBroken", None),
        ("AS0001", "error", None, "x"), ("AW0001", "warning", None, "spacing"), ("LC0001", "warning", None, "use qualified names"), ("LC0002", "warning", None, "magic"), ("FC0001", "info", None, "Casing of keywords"), ("FC0001", "info", None, "Casing of keywords"), (None, "error", None, None),
    ]
    got = {r.code: tuple(r)[2:] for r in report.diagnostics_catalogue(spark.createDataFrame(data, "code string, severity string, name string, text string")).collect()}
    assert got == {
        "AL0001": ("lexical", "medium", "deterministic", "corrupt_literal"), "AL0002": ("obsoletion", "low", "model", "reference_obsolete"), "AL0003": ("metadata", "none", "none", None), "AL0004": ("binding", "high", "model", "rename_identifier"),
        "AL0005": ("syntax", "high", "deterministic", "delete_token"), "AL0006": ("semantic", "none", "none", None), "AL0007": ("semantic", "low", "model", None), "AL0008": ("semantic", "medium", "model", None), "AL0009": ("other", "low", "model", None),
        "AL0010": ("type", "high", "model", "change_var_type"), "AL0011": ("metadata", "none", "none", None), "AS0001": ("metadata", "none", "model", None), "AW0001": ("analyzer-correctness", "low", "model", None),
        "LC0001": ("analyzer-correctness", "low", "analyzer-codefix", None), "LC0002": ("analyzer-correctness", "low", "model", None), "FC0001": ("analyzer-style", "medium", "analyzer-codefix", "case_mismatch_keyword"),
    }
    full = spark.createDataFrame(data, "code string, severity string, name string, text string")
    given = spark.createDataFrame([("AL0008", "high", "model", "m")], "code string, likelihood string, strategy string, mutation string")
    ranked = [r.code for r in report.ranked_by_likelihood(report.diagnostics_catalogue(full, given), 6).collect()]
    assert ranked == ["AL0004", "AL0005", "AL0008", "AL0010", "AL0001", "FC0001"]
