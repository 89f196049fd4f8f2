"""Single-site edits of AL members that break them in a known way."""

from __future__ import annotations

from collections.abc import Callable

from .al import Token, block_end, tokens

# The code(s) each edit is meant to provoke, in catalogue order.
EXPECTED = {
    "m_delete_semicolon": ["AL0111"],
    "m_rename_call": ["AL0132", "AL0118"],
    "m_rename_member": ["AL0132"],
    "m_rename_identifier": ["AL0118"],
    "m_remove_var_decl": ["AL0118"],
    "m_rename_type": ["AL0134", "AL0185", "AL0118"],
    "m_rename_trigger": ["AL0162"],
    "m_swap_argument_count": ["AL0126"],
    "m_add_parens_to_property": ["AL0127", "AL0125"],
    "m_semicolon_before_else": ["AL0110"],
    "m_delete_begin": ["AL0104", "AL0109"],
    "m_delete_then": ["AL0104"],
    "m_keyword_as_identifier": ["AL0105", "AL0104"],
    "m_change_var_type": ["AL0122"],
}
RESERVED = ("begin", "var", "then", "procedure", "trigger", "end", "case")
NUMERIC, TEXTUAL = ("integer", "decimal", "biginteger", "duration", "byte"), ("text", "code", "char")
KEYWORDS = frozenset("if then else case of for to downto do while repeat until with begin end exit not and or div mod in var procedure trigger foreach break asserterror true false local internal protected temporary".split())


class Source:
    """A member's tokens and what the edits need of them."""

    def __init__(self, text: str):
        self.text, self.t = text, tokens(text)
        low = [x.low for x in self.t]
        self.body = next((i for i, x in enumerate(low) if x == "begin"), len(low))
        self.stop = block_end(self.t, self.body) if self.body < len(low) else len(low)
        self.var = next((i for i in range(self.body) if low[i] == "var" and self.text[: self.t[i].start].count("(") == self.text[: self.t[i].start].count(")")), None)

    def splice(self, start: int, end: int, by: str) -> str:
        return self.text[:start] + by + self.text[end:]

    def locals(self) -> list[tuple[int, int, int]]:
        """(name, first type token, closing semicolon) of every declared variable."""
        if self.var is None:
            return []
        out, i = [], self.var + 1
        while i < self.body:
            end = next((j for j in range(i, self.body) if self.t[j].text == ";"), None)
            colon = next((j for j in range(i, end or self.body) if self.t[j].text == ":"), None)
            if end is None:
                break
            if colon is not None and self.t[i].kind in ("word", "quoted") and colon + 1 < end:
                out.append((i, colon + 1, end))
            i = end + 1
        return out

    def uses(self, name: str) -> list[int]:
        return [i for i in range(self.body, self.stop) if self.t[i].kind in ("word", "quoted") and self.t[i].low == name.lower() and self.t[i - 1].text not in (".", "::")]

    def calls(self) -> list[int]:
        return [i for i in range(self.body, self.stop - 1) if self.t[i].kind in ("word", "quoted") and self.t[i + 1].text == "(" and self.t[i].low not in KEYWORDS]

    def fields(self) -> list[int]:
        """Members accessed without a call."""
        return [i for i in range(self.body + 2, self.stop) if self.t[i - 1].text == "." and self.t[i].kind in ("word", "quoted") and not (i + 1 < len(self.t) and self.t[i + 1].text == "(")]


def _named(tok: Token, make: Callable[[str], str]) -> str:
    inner = tok.text.strip('"')
    return f'"{make(inner)}"' if tok.kind == "quoted" else make(inner)


def m_delete_semicolon(s: Source, m: dict):
    for i in range(s.body + 1, s.stop - 1):
        if s.t[i].text == ";" and s.t[i - 1].low not in ("begin", "end"):
            return s.splice(s.t[i].start, s.t[i].end, ""), "deleted the semicolon after a statement"
    return None


def m_rename_call(s: Source, m: dict):
    for i in s.calls():
        return s.splice(s.t[i].start, s.t[i].end, _named(s.t[i], lambda n: n + "X")), f"renamed the call of {s.t[i].text}"
    return None


def m_rename_member(s: Source, m: dict):
    for i in s.fields():
        return s.splice(s.t[i].start, s.t[i].end, _named(s.t[i], lambda n: "Nonexistent" + n[:20])), f"renamed the member {s.t[i].text}"
    return None


def _first_used(s: Source):
    found = [(use[0], d) for d in s.locals() if (use := s.uses(s.t[d[0]].text))]
    return min(found, default=None)


def m_rename_identifier(s: Source, m: dict):
    hit = _first_used(s)
    if not hit:
        return None
    t = s.t[hit[0]]
    return s.splice(t.start, t.end, _named(t, lambda n: n + "2")), f"renamed one use of {t.text}"


def m_remove_var_decl(s: Source, m: dict):
    hit = _first_used(s)
    if not hit:
        return None
    name, _, end = hit[1]
    if len(s.locals()) == 1:
        return s.splice(s.t[s.var].start, s.t[end].end, ""), f"removed the declaration of {s.t[name].text}"
    return s.splice(s.t[name].start, s.t[end].end, ""), f"removed the declaration of {s.t[name].text}"


def _misspelt(t: Token) -> str:
    """A name with a letter less: the last of a quoted one, the last but one of a type; short ones get one more."""
    if t.kind == "quoted":
        return _named(t, lambda n: n[:-1] if len(n) > 3 else n + "X")
    return t.text[:-2] + t.text[-1] if len(t.text) > 4 else t.text + "x"


def m_rename_type(s: Source, m: dict):
    for _, kind, end in s.locals():
        subtype = kind + 1 < end and s.t[kind + 1].kind in ("word", "quoted") and s.t[kind + 1].low != "temporary"
        t = s.t[kind + 1 if subtype else kind]
        new = t.text + "X" if subtype and t.kind == "word" else _misspelt(t)
        return s.splice(t.start, t.end, new), f"misspelled the type {t.text} as {new}"
    return None


def m_rename_trigger(s: Source, m: dict):
    if m.get("member_kind") != "trigger":
        return None
    at = next((i for i, t in enumerate(s.t) if t.low == "trigger"), None)
    if at is None or at + 1 >= len(s.t):
        return None
    t = s.t[at + 1]
    return s.splice(t.start, t.end, "OnAfterRun" if t.low == "onrun" else _named(t, lambda n: n + "Xyz")), f"renamed the trigger {t.text}"


def m_swap_argument_count(s: Source, m: dict):
    for i in s.calls():
        depth, j = 0, i + 1
        while j < len(s.t):
            depth += (s.t[j].text in "([") - (s.t[j].text in ")]")
            if depth == 0 or depth == 1 and s.t[j].text == ",":
                break
            j += 1
        if j < len(s.t) and j > i + 2:
            first = s.text[s.t[i + 2].start : s.t[j - 1].end]
            return s.splice(s.t[i + 2].start, s.t[i + 2].start, first + ", "), f"repeated the first argument of {s.t[i].text}"
    return None


def m_add_parens_to_property(s: Source, m: dict):
    for i in s.fields():
        return s.splice(s.t[i].end, s.t[i].end, "()"), f"called the property {s.t[i].text}"
    return None


def m_semicolon_before_else(s: Source, m: dict):
    for i in range(s.body, s.stop):
        if s.t[i].low == "else" and s.t[i - 1].text not in (";", "of"):
            return s.splice(s.t[i - 1].end, s.t[i - 1].end, ";"), "put a semicolon before else"
    return None


def m_delete_begin(s: Source, m: dict):
    found = [i for i in range(s.body, s.stop) if s.t[i].low == "begin"]
    return (s.splice(s.t[found[-1]].start, s.t[found[-1]].end, ""), "deleted a begin") if found else None


def m_delete_then(s: Source, m: dict):
    for i in range(s.body, s.stop):
        if s.t[i].kind == "word" and s.t[i].low == "then":
            return s.splice(s.t[i].start, s.t[i].end, ""), "deleted a then"
    return None


def m_keyword_as_identifier(s: Source, m: dict):
    hit = _first_used(s)
    if not hit:
        return None
    name = s.t[hit[1][0]].text
    word = RESERVED[len(name.strip('"')) % len(RESERVED)]
    text = s.text
    for i in reversed([hit[1][0], *s.uses(name)]):
        text = text[: s.t[i].start] + word + text[s.t[i].end :]
    return text, f"renamed {name} to the keyword {word}"


def m_change_var_type(s: Source, m: dict):
    for name, kind, end in s.locals():
        if not s.uses(s.t[name].text):
            continue
        low = s.t[kind].low
        new = "Boolean" if low in NUMERIC else "Integer" if low in TEXTUAL else None
        if new:
            return s.splice(s.t[kind].start, s.t[end].start, new), f"changed the type of {s.t[name].text} to {new}"
    return None


CATALOGUE = {name: globals()[name] for name in EXPECTED}


def mutate(text: str, member: dict) -> list[tuple[str, str, str]]:
    """(mutation, broken text, description) for every edit that applies and changes the text, in catalogue order."""
    source, out = Source(text), []
    for name, edit in CATALOGUE.items():
        try:
            hit = edit(source, member)
        except (IndexError, ValueError):  # odd sources: this edit does not apply
            continue
        if hit and hit[0] != text:
            out.append((name, *hit))
    return out
