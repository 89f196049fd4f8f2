import pytest

from sedimenta.llm import encoding as E
from sedimenta.llm.encoding import repair_encoding
from tests.conftest import rows

CLEAN = [
    "Für jede Prüfgröße lässt sich eine eigene Übersicht einrichten",
    "La transacción se envía automáticamente según la configuración",
    "L’échéance est créée dès que la période a été validée",
    "Der Schlüssel gehört zur Währung und wird nicht rückwirkend gelöscht",
    "As informações da exceção serão incluídas na transação",
    "A fee of €{n} applies … see the “internal sensor” chapter – it explains",
]


def garbled(text, true, wrong):
    return text.encode(true, "replace").decode(wrong, "replace")


def corpus():
    data = [(i, CLEAN[i % len(CLEAN)].replace("{n}", str(i * 7))) for i in range(240)]
    bad = {}
    chains = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "utf-8")]
    i = 1000
    for true, wrong in chains:
        for k in range(5):
            for s in CLEAN[:5]:
                i += 1
                bad[i] = (E.garble(s, (true, wrong)) if wrong != "utf-8" else garbled(s, true, wrong), s)
    return data, bad


def test_found_and_repaired(spark):
    data, bad = corpus()
    signs = [
        (5001, "Локаль: ru-RU, подпись «Настройка журнала», поле"), (5002, "├── src\n│   ├── a.al\n└── b.al"), (5003, "√(σ² + Δ²) ≤ 61 µm"), (5004, "łączna kwota, źródło, wartość"),
        (5005, "© Some ® Name™ § 96 ¶ 3"), (5006, "NÃO altere a AÇÃO: ÀÇÂÊÎÔÛ"), (5007, "plain ASCII & text"), (5008, None), (5009, ""), (5010, "tagged &copy; and &amp; sign"),
    ]
    more = [(6001, "the sign was lost � here"), (6002, "escaped F&Atilde;&frac14;r jede Sache"), (6003, "Maßeinheit und PrÃ¼fgrÃ¶ÃŸe gemischt")]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in [*data, *[(i, g) for i, (g, _) in bad.items()], *signs, *more, (1001, bad[1001][0]), (None, bad[1001][0])]], "doc_id long, text string, form string, key int")
    r = repair_encoding(df, "doc_id", "text")
    found = {x[0] for x in rows(r.found())}
    assert found == set(bad) | {6001, 6002, 6003}
    fixed = {x.id: (x.text, x.recovered) for x in r.repaired().collect()}
    wrong = [(i, fixed[i][0], s) for i, (_, s) in bad.items() if fixed[i][0] != s]
    assert len(wrong) <= 0.02 * len(bad), wrong[:5]
    assert fixed[6003][0] == "Maßeinheit und Prüfgröße gemischt" and fixed[6002][0] == "escaped Für jede Sache"
    assert {(x.true_encoding, x.read_as) for x in r.learned().collect()} >= {("utf-8", "cp1252"), ("cp1252", "cp437"), ("utf-8", "mac_roman")}


def test_empty_and_ascii_only(spark):
    assert repair_encoding(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").found().count() == 0
    assert repair_encoding(spark.createDataFrame([(1, "just text"), (2, None)], "doc_id long, text string"), "doc_id", "text").found().count() == 0


@pytest.mark.parametrize("chain", E.CHAINS)
def test_undo_is_the_inverse_of_garble(chain):
    alphabet = sorted(set("éüåäóøöæíáñèßçãõêàôúÄÖÜÅ€’“”–…"))
    undo = E.Undo(alphabet, {(E.CHAINS.index(chain), "")})
    for word in ("Prüfgröße", "créée", "transação", "doesn’t", "på"):
        g = E.garble(word, chain)
        if g != word and not any(ch in alphabet for ch in g):
            assert word in {o for o, *_ in undo.word(g)}


def test_cells_keep_their_place():
    text = "x „Maß“, (naïve) NBSP here &eacute;\tend."
    for start, end, form, _ in E.cells(E.unescape(text)):
        assert E.unescape(text)[start:end] == form
    assert [f for *_, f, _ in E.cells("„Maß“, (naïve)")] == ["„Maß“", "naïve"]
    assert E.unescape("&amp;eacute; &lt; &eacute; &bogus; &#233; &#xE9;") == "é &lt; é &bogus; é é"


def test_fill_takes_runs_in_order():
    assert E.fill("Pr�fgr��e", "prüfgröße") == "Prüfgröße" and E.fill("�NDERUNG", "änderung") == "ÄNDERUNG" and E.fill("a�", "aüöb") == "a�"


@pytest.mark.parametrize("chain", [("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "koi8-r"), ("utf-8", "cp1252")])
@pytest.mark.parametrize("copies", [True, False])
def test_a_garbled_majority_does_not_turn_the_direction(spark, chain, copies):
    clean = [(i, f"{CLEAN[i % 5]} number {i}") for i in range(20)]
    bad = {100 + i: (E.garble(s, chain), s) for i in range(200) for s in [f"{CLEAN[i % 5]} note {'' if copies else i}"]}
    r = repair_encoding(spark.createDataFrame([*clean, *((i, g) for i, (g, _) in bad.items())], "doc_id long, text string"), "doc_id", "text")
    assert {x[0] for x in rows(r.found())} == set(bad)
    fixed = {x.id: x.text for x in r.repaired().collect()}
    assert sum(fixed[i] != s for i, (_, s) in bad.items()) <= 0.02 * len(bad)


def test_repeated_rows_and_copies_have_no_vote(spark):
    # letters that do not tell: capitals on both sides
    data = [(i, f"DIE GRÖSSE {i}") for i in range(3)] + [(10, E.garble("DIE GRÖSSE", ("cp1252", "cp1250")).replace("Ö", "Ő"))] * 9
    counted = E.repair_encoding(spark.createDataFrame(data, "doc_id long, text string"), "doc_id", "text", scratch=None)
    n = {r.form: (r.n, r.texts) for r in counted.forms.collect()}
    assert n == {"GRÖSSE": (3, 3), "GRŐSSE": (1, 1)}


def test_odd_letters():
    assert [E.odd(w) for w in ("Prüfgröße", "ÄNDERUNG", "doesn’t", "«été»", "Настройка", "10°", "łączna")] == [0] * 7
    assert all(E.odd(w) for w in ("Prⁿfgr÷▀e", "crÈÈe", "PrьfgrцЯe", "Pr\x81fung", "fⁿr"))


def test_lower_cased_garbling_without_a_twin(spark):
    clean = [(i, f"{CLEAN[i % 5]} number {i}") for i in range(60)]
    bad = [(100 + i, E.garble(f"{CLEAN[i % 5]} note {i}", ("utf-8", "cp1252"), "lower")) for i in range(40)]
    alone = (200, E.garble("Ein Türöffner", ("utf-8", "cp1252"), "lower"))
    r = repair_encoding(spark.createDataFrame([*clean, *bad, alone], "doc_id long, text string"), "doc_id", "text")
    assert {x[0] for x in rows(r.found())} == {i for i, _ in bad} | {200}
    assert {x.id: x.text for x in r.repaired().collect()}[200] == "ein türöffner"


OWN = tuple(zip("éüöä", "Þ¯¬¦"))
WORDS = ["Une année créée après été, la clé perdue", "Über fünf Bücher müssen zurück zur Tür", "Schöne Größen können böse Töne hören", "Später wählen wir Käse, Äpfel und Gläser, nächste Jahre"]


@pytest.mark.parametrize("chain", [("utf-8", "cp1257"), ("utf-8", "cp775"), ("cp1252", "cp1253"), (OWN, None)])
def test_transformations_in_no_list_are_inferred(spark, chain):
    """Two encodings that are not among the usual ones, and a mapping that no two encodings explain."""
    assert chain not in E.CHAINS
    lines = CLEAN[:5] if chain[1] else WORDS
    clean = [(i, f"{lines[i % len(lines)]} number {i}") for i in range(60)]
    bad = {100 + i: (E.garble(s, chain), s) for i in range(50) for s in [f"{lines[i % len(lines)]} note {i}"]}
    bad = {i: x for i, x in bad.items() if x[0] != x[1]}
    r = repair_encoding(spark.createDataFrame([*clean, *((i, g) for i, (g, _) in bad.items())], "doc_id long, text string"), "doc_id", "text")
    found = {x[0] for x in rows(r.found())}
    assert found <= set(bad) and len(found) >= 0.9 * len(bad)
    fixed = {x.id: x.text for x in r.repaired().collect()}
    assert sum(fixed.get(i) == s for i, (_, s) in bad.items()) >= 0.9 * len(bad)


def test_what_explains_alignments():
    pair = ("cp1252", "cp1253")
    seen = [(E.garble(ch, pair), ch, 4) for ch in "éüöäß" if E.garble(ch, pair) != ch]
    got = E.infer(seen, 3, known=[])
    assert got and all(any(E.garble(ch, c) == g for c in got) for g, ch, _ in seen)
    assert E.infer([("Ã¼", "ü", 9), ("Ã¶", "ö", 9)], 3) == []  # known
    assert E.infer([("☃", "ü", 9), ("☃", "ö", 5), ("☄", "ö", 2)], 3) == []  # ambiguous, or shown by too few
    assert E.infer([("☃", "ü", 9)], 3) == [((("ü", "☃"),), None)]
    assert E.aligned("PrÃ¼fgrÃ¶ÃŸe", "Prüfgröße") == [("Ã¼", "ü"), ("Ã¶", "ö"), ("ÃŸ", "ß")]
    assert E.aligned("für", "fur") == E.aligned("für", "für") == E.aligned("f�r", "für") == E.aligned("fér", "für") == []


def test_words_of_other_alphabets_have_keys_of_their_own():
    russian = "Настройка журнала, поле: подпись и сумма"
    greek = "Ο λογαριασμός είναι κλειστός"
    keys = [k for *_, k in E.cells(f"{russian}\n{greek}")]
    assert len(set(keys)) == len(keys) == 10
    assert keys[:6] == [k for *_, k in E.cells(E.garble(russian, ("utf-8", "cp1252")).replace("\xa0", "¶"))]


def test_garbled_text_of_another_alphabet(spark):
    lines = ["Настройка журнала, поле: подпись и сумма", "Сумма заказа - без скидки (всего), к оплате", "Клиент: новый адрес; старый счет закрыт"]
    data = [(i, lines[i % 3]) for i in range(30)]
    bad = [(100 + i, E.garble(lines[i % 3], ("utf-8", "cp1252"))) for i in range(6)]
    r = repair_encoding(spark.createDataFrame([*data, *bad], "doc_id long, text string"), "doc_id", "text")
    assert {x[0] for x in rows(r.found())} == {i for i, _ in bad}
    assert sum(x.text == lines[(x.id - 100) % 3] for x in r.repaired().collect()) >= 5
