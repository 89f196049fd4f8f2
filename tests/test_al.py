import pytest

from sedimenta.functions import al, mutations, repair
from sedimenta.operators import gate

PROC = """procedure Post(var Rec: Record "Sales Header"; Count: Integer): Boolean
    var
        Total: Decimal;
        Name: Text[50];
    begin
        if Rec.FindSet() then
            repeat
                Total += Rec.Amount;
                Name := CopyStr(Rec.Name, 1, 50);
            until Rec.Next() = 0
        else
            Error('none');
        exit(Total > 0);
    end;"""
TRIGGER = "trigger OnRun()\n    var\n        X: Integer;\n    begin\n        X := 1;\n    end;"


@pytest.mark.parametrize("name", list(mutations.CATALOGUE))
def test_each_mutation_applies(name):
    text, kind = (TRIGGER, "trigger") if name == "m_rename_trigger" else (PROC, "procedure")
    hit = mutations.CATALOGUE[name](mutations.Source(text), {"member_kind": kind})
    assert hit and hit[0] != text and hit[1]


def test_mutations_that_do_not_apply():
    assert mutations.m_rename_trigger(mutations.Source(PROC), {"member_kind": "procedure"}) is None
    empty = "procedure X()\n    begin\n    end;"
    assert [n for n, *_ in mutations.mutate(empty, {"member_kind": "procedure"})] == ["m_delete_begin"]
    assert mutations.mutate("", {}) == []


def test_mutations_leave_strings_and_comments_alone():
    text = "procedure X()\n    begin\n        Message('if a then b; else'); // begin ; else\n    end;"
    assert dict((n, b) for n, b, _ in mutations.mutate(text, {}))["m_delete_semicolon"].count("'if a then b; else'") == 1


SRC = """// file header

codeunit 50000 "My Unit"
{
    Subtype = Test;

    /// <summary>Does it.</summary>
    [Attr(1)]
    local procedure A(X: Record "B; C"): Text[10]
    begin
        // procedure Fake()
        case X.Y of
            1: begin end;
        end;
    end;

    // far away

    procedure B();

    trigger OnRun()
    begin
    end;
}
enum 7 Color { value(0; Red) { } }
"""


def test_objects_and_members():
    unit, enum = al.objects(SRC)
    assert (unit.kind, unit.object_id, unit.name, unit.is_test) == ("codeunit", 50000, "My Unit", True)
    assert [(m.name, m.is_local, m.body_start is not None) for m in unit.members] == [("A", True, True), ("B", False, False), ("OnRun", False, True)]
    a, b, _ = unit.members
    assert a.signature == 'local procedure A(X: Record "B; C"): Text[10]' and a.attributes == ["[Attr(1)]"] and "Does it" in a.doc_comment
    assert b.doc_comment == "" and a.text.endswith("end;")
    assert (enum.kind, enum.name, enum.members) == ("enum", "Color", [])
    assert al.objects("") == [] and al.objects("no object here {") == []


def test_extraction_rows(spark):
    from sedimenta.operators import extract

    df = spark.createDataFrame([(1, SRC), (2, None), (3, ""), (4, "codeunit 1 X { procedure P() begin")], "file_id long, content string")
    m = extract.members(df, "file_id", "content")
    got = {(r.file_id, r.member_name, r.has_body, r.body_loc) for r in m.collect()}
    assert (1, "A", True, 6) in got and (1, "B", False, 0) in got and (4, "P", True, 1) in got and len(got) == 4
    o = extract.objects(df, "file_id", "content")
    assert o.count() == 3


def test_edit_distance_and_nearest():
    assert [repair.distance(a, b) for a, b in (("Foo", "Foo"), ("FooX", "Foo"), ("Fooo", "Foo"), ("abcdef", "xyz"))] == [0, 1, 1, 3]
    assert repair.nearest("Postt", {"Post", "Other"}) == "Post"
    assert repair.nearest("Post", {"Pots", "Past"}) is None
    assert repair.nearest("Postt", {"Post", "POST"}) == "POST"


@pytest.mark.parametrize(
    "text, finding, want",
    [
        ("a := 1\nb := 2;", repair.Finding(1, 7, "AL0111"), "a := 1;\nb := 2;"),
        ("if x then\n    y();\nelse\n    z();", repair.Finding(3, 1, "AL0110"), "if x then\n    y()\nelse\n    z();"),
        ("x := (1;", repair.Finding(1, 8, "AL0104", "')' expected"), "x := (1);"),
        ("var: Integer; var := 1;", repair.Finding(1, 1, "AL0105", "'var' is a keyword"), "varValue: Integer; varValue := 1;"),
        ("using A.B;\nusing C;\nx", repair.Finding(1, 1, "AL0791", "namespace 'A.B' is unknown"), "using C;\nx"),
        ("Total := 1; Totl := 2;", repair.Finding(1, 13, "AL0118", "The name 'Totl' does not exist"), "Total := 1; Total := 2;"),
    ],
)
def test_single_repairs(text, finding, want):
    fixer = repair.Repairer()
    assert (fixer.structural(text, finding) or fixer.near_name(text, finding)) == want


@pytest.mark.parametrize(
    "text, finding, want",
    [
        ("procedure P()\nbegin\n    exit(InsertFileContent())\nend;", repair.Finding(3, 30, "AL0111", "Semicolon expected."), "procedure P()\nbegin\n    exit(InsertFileContent());\nend;"),
        ("a := 1 // why\n\nb := 2;", repair.Finding(3, 1, "AL0111"), "a := 1; // why\n\nb := 2;"),
        ("begin\n;", repair.Finding(2, 1, "AL0111"), None),
        ("if X then Y(); else Z();", repair.Finding(1, 1, "AL0110"), "if X then Y() else Z();"),
        ("Message('; else');", repair.Finding(1, 1, "AL0110"), None),
        ("using Foo.Bar.Baz;\nusing System.Utilities;\ncodeunit 50000 X\n{\n}", repair.Finding(1, 1, "AL0791", "The namespace 'Foo.Bar.Baz' is unknown."), "using System.Utilities;\ncodeunit 50000 X\n{\n}"),
        ("var\n    exit: Integer;\nbegin\n    exit := 1;\n    exit;\nend;", repair.Finding(1, 10, "AL0105", "Syntax error, identifier expected; 'exit' is a keyword"), "var\n    exitValue: Integer;\nbegin\n    exitValue := 1;\n    exit;\nend;"),
        ("var\n    CustNo: Code[20];\nbegin\n    Message(CustNo2); // CustNo2\nend;", repair.Finding(1, 1, "AL0118", "The name 'CustNo2' does not exist in the current context."), "var\n    CustNo: Code[20];\nbegin\n    Message(CustNo); // CustNo2\nend;"),
        ("trigger OnAfterGetRecrd()\nbegin\nend;", repair.Finding(1, 1, "AL0162", "'OnAfterGetRecrd' is not a valid trigger for this object type."), "trigger OnAfterGetRecord()\nbegin\nend;"),
        ("x", repair.Finding(9, 9, "AL0104", "'end' expected"), "xend "),
        ("x", repair.Finding(1, 1, "AL0104", "'banana' expected"), None),
        ("x", repair.Finding(1, 1, "ZZ1"), None),
    ],
)
def test_edits_on_tokens(text, finding, want):
    fixer = repair.Repairer()
    assert (fixer.structural(text, finding) or fixer.near_name(text, finding)) == want


def test_analyzer_fixes_are_the_last_resort():
    check = lambda t: [repair.Finding(1, 1, "AL0999")] if "bad" in t else []
    assert repair.repair("bad", check, code_fix=lambda t: t.replace("bad", "good")) == ("good", "analyzer-codefix")
    assert repair.repair("bad", check, code_fix=lambda t: t) == (None, "unfixable:AL0999")


def test_fixes_of_a_file_come_back_by_member():
    src = "codeunit 5 X { procedure A() begin one() ; end; procedure B() begin two(); end; }"
    analyze = lambda t: [repair.Finding(1, t.index(" ;") + 1, "FC1", severity="warning")] if " ;" in t else []
    fix = lambda t, f: t.replace(" ;", ";", 1)
    assert repair.fixed_file(src, [("A", None), ("Z", None)], analyze, fix) == [(0, "procedure A() begin one(); end;", ["FC1"])]
    assert repair.fixed_file(src.replace(" ;", ";"), [("A", None)], analyze, fix) == []


def test_repair_loop():
    def check(text):
        return [repair.Finding(1, 1, "AL0118", "The name 'Totl' does not exist")] if "Totl" in text else []

    assert repair.repair("Total; Totl;", check) == ("Total; Total;", "near-name")
    assert repair.repair("fine", check) == ("fine", "already-clean")
    assert repair.repair("Totl;", check) == (None, "unfixable:AL0118")


def test_gate(spark):
    cand = spark.createDataFrame(
        [
            (1, "g1_fim", "begin end", None, 1, "x begin  end y"),
            (2, "g1_fim", "begin", None, 2, None),
            (3, "g3_explain", None, None, None, None),
            (4, "g5_error_fix", "begin end", "begin", 2, None),
            (5, "g5_error_fix", "begin end", "begin end ", 2, None),
        ],
        "id long, gen string, target_al string, rejected_al string, app long, origin string",
    )
    apps = spark.createDataFrame([(1, True), (2, False)], "app long, error_clean boolean")
    v = {r.id: (r.kept, r.via) for r in gate.verdicts(cand, apps, gate.brackets_check).collect()}
    assert v == {1: (True, "verbatim"), 2: (False, "check"), 3: (True, "text"), 4: (True, "check"), 5: (False, "check")}


def test_memo_calls_once(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, t string")
    memo = spark.createDataFrame([("x", ["Z"])], "key string, codes array<string>")
    full, fresh = gate.with_memo(df, "t", memo, lambda t: 1 / 0 if t == "b" else [t.upper()])
    assert {r.id: r.codes for r in full.collect()} == {1: ["A"], 2: ["A"], 3: ["EXCEPTION"], 4: None}
    assert fresh.count() == 2


def test_baselines(spark):
    apps = spark.createDataFrame([(1,), (2,), (3,)], "app long")
    files = spark.createDataFrame([(1, "begin end"), (2, "begin"), (2, "x"), (None, "y")], "app long, text string")
    got = {r.app: (r.error_clean, r.n_errors, r.error_codes) for r in gate.baselines(apps, files, gate.brackets_check).collect()}
    assert got == {1: (True, 0, []), 2: (False, 1, ["AL0104"]), 3: (True, 0, [])}


def test_find_splice_and_wrap():
    src = "codeunit 5 X { procedure A(I: Integer) begin one(); end; procedure A(T: Text) begin two(); end; }"
    assert "two" in al.find_member(src, "a", "procedure A( T:Text )").text and "one" in al.find_member(src, "A", "procedure A(Z: Guid)").text
    assert al.find_member(src, "B") is None
    m = al.find_member(src, "A", "procedure A(T: Text)")
    out = al.splice(src, m, "procedure B() begin end;")
    assert [x.name for x in al.objects(out)[0].members] == ["A", "B"]
    assert al.with_object_id(src, 77).startswith("codeunit 77 X") and al.with_object_id("procedure A()", 7) == "procedure A()"
    assert al.wrapped(src) == (src, 0) and al.wrapped("procedure A() begin end;")[1] == 2


def test_fix_loop_ends():
    def analyze(t):
        return [repair.Finding(i + 1, 1, "FC1", severity="warning") for i, x in enumerate(t.split("\n")) if x.endswith(" ")]

    def fix(t, f):
        lines = t.split("\n")
        lines[f.line - 1] = lines[f.line - 1].rstrip()
        return "\n".join(lines)

    assert repair.apply_fixes("a \nb\nc ", analyze, fix) == ("a\nb\nc", ["FC1", "FC1"])
    flip = lambda t, f: t.replace("a", "b ") if "a" in t else t.replace("b", "a")
    assert len(repair.apply_fixes("a ", analyze, flip)[1]) <= 6
    assert repair.strategy("X", {}) == "model" and repair.strategy("X", {"X": "deterministic"}) == "deterministic"


APP_FILE = "codeunit 5 X { procedure A() begin one(); end; procedure B() begin two(); end; }"


def test_checks_in_the_file_a_candidate_comes_from(spark):
    a, b = "procedure A() begin one(); end;", "procedure B() begin two(); end;"
    data = [
        (1, "g1_fim", a, None, 1, "f", "A", None), (2, "g1_fim", "procedure A() begin new(); end;", None, 1, "f", "A", None), (3, "g1_fim", "procedure A() begin new(;", None, 1, "f", "A", None), (4, "g5_error_fix", b, "procedure B() begin two(;", 1, "f", "B", None),
        (5, "g5_error_fix", b, "procedure B() begin two(;", 2, "f", "B", None), (6, "g6_spec2object", "enum 7 Color { }", None, 1, "f", None, None), (7, "g3_explain", None, None, None, None, None, None), (8, "g1_fim", a, None, 1, "gone", "A", None),
        (9, "g1_fim", "procedure Z() begin end;", None, 1, "f", "Z", None), (10, "g5_error_fix", b, b, 1, "f", "B", None),
    ]
    c = spark.createDataFrame(data, "id long, gen string, target_al string, rejected_al string, app long, path string, member string, signature string")
    apps = spark.createDataFrame([(1, True), (2, False)], "app long, error_clean boolean")
    files = spark.createDataFrame([(1, "f", APP_FILE), (2, "f", APP_FILE), (3, "f", None)], "app long, path string, text string")
    v = gate.verified(c, apps, files, gate.brackets_check)
    got = {r.id: (r.kept, r.via) for r in v.collect()}
    assert got == {
        1: (True, "verbatim"), 2: (True, "inapp"), 3: (False, "inapp"), 4: (True, "inapp"), 5: (False, "origin not clean"), 6: (True, "fresh-app"), 7: (True, "text"), 8: (False, "no origin"), 9: (False, "inapp"), 10: (False, "inapp"),
    }
    assert {r.gen: (r.n_in, r.n_kept, r.pass_rate) for r in gate.pass_rates(v, "gen").collect()}["g5_error_fix"] == (3, 1, 0.333)
    assert gate.verified(c.limit(0), apps, files, gate.brackets_check).count() == 0
    assert gate.verified(c, apps, files, gate.brackets_check, mode="compile").where("id = 3").first().kept is False
    with pytest.raises(ValueError):
        gate.verified(c, apps, files, gate.brackets_check, mode="other")


def test_candidates_are_read_and_texts_checked_once(spark):
    """What led to the candidates is not computed again for every side, and equal files are checked once over all apps."""
    read, calls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    def check(text):
        calls.add(1)
        return gate.brackets_check(text)

    b, bad = "procedure B() begin two(); end;", ["procedure B() begin two(;", "procedure B() begin two(]);", "procedure B() begin two(});"]
    data = [(app * 10 + i, "g5_error_fix", b, x, app, "f", "B", None) for app in (1, 2) for i, x in enumerate(bad)]
    c = spark.createDataFrame(data, "id long, gen string, target_al string, rejected_al string, app long, path string, member string, signature string")
    apps = spark.createDataFrame([(1, True), (2, True)], "app long, error_clean boolean")
    files = spark.createDataFrame([(1, "f", APP_FILE), (2, "f", APP_FILE)], "app long, path string, text string")
    v = gate.verified(c.mapInArrow(counted, c.schema), apps, files, check)
    assert {(r.id, r.kept, r.reason) for r in v.collect()} == {(x[0], True, "pair") for x in data}
    assert read.value == 6 and calls.value == 4


def test_fixes_of_files_and_their_members(spark):
    from sedimenta.operators import generate

    files = spark.createDataFrame([(1, "f", APP_FILE.replace("one()", "one() ")), (1, "g", APP_FILE), (2, "f", None)], "app long, path string, text string")
    members = spark.createDataFrame([(10, 1, "f", "A", None), (11, 1, "f", "B", None), (12, 1, "f", "Gone", None), (13, 1, "g", "A", None), (14, None, None, None, None), (None, 1, "f", "A", None)], "record_id long, app long, path string, member string, signature string")
    analyze = lambda t: [repair.Finding(1, 1, "FC1", severity="warning")] if ") ;" in t else []
    got = generate.fixed_members(files, members, analyze, lambda t, f: t.replace(") ;", ");", 1))
    assert {(r.record_id, r.fixed_text, tuple(r.applied_rules)) for r in got.collect()} == {(10, "procedure A() begin one(); end;", ("FC1",)), (11, "procedure B() begin two(); end;", ("FC1",))}


def test_every_if_waits_for_its_then():
    far = "procedure A() begin if " + " and ".join(f"F{i}(x, {i})" for i in range(40)) + " then exit; end;"
    assert gate.brackets_check(far) == []
    assert gate.brackets_check("begin if a b(); if c then d(); end") == ["AL0104"] and gate.brackets_check("begin a then b(); end") == ["AL0104"]


def test_types_are_misspelt():
    text = lambda kind: f"procedure P()\n    var\n        X: {kind};\n    begin\n        X := 1;\n    end;"
    bad = lambda kind: mutations.m_rename_type(mutations.Source(text(kind)), {})[0].split("X: ")[1].split(";")[0]
    assert [bad(k) for k in ("Integer", "Text", 'Record "Sales Line"', "Record Item", 'Codeunit "Abc"')] == ["Integr", "Textx", 'Record "Sales Lin"', "Record ItemX", 'Codeunit "AbcX"']


def test_lines_of_a_wrapper_are_taken_off(spark):
    from sedimenta.operators import extract

    d = spark.createDataFrame([(5, 2, "a"), (1, 2, "b"), (4, None, "c"), (None, 2, "d")], "line int, shift int, code string")
    assert {(r.code, r.line) for r in extract.unwrapped(d).collect()} == {("a", 3), ("b", 1), ("c", 4), ("d", 1)}
    assert extract.GATE_PREFIXES == tuple(p for p in extract.ANALYZER_PREFIXES if p != "AW")
