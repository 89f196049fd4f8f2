"""A tokenizer for AL and what is read off its tokens: objects, members, spans."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

# The kinds of objects a file can declare.
OBJECT_KINDS = (
    "codeunit", "table", "tableextension", "page", "pageextension", "pagecustomization", "enum", "enumextension", "report", "reportextension", "query",
    "xmlport", "interface", "permissionset", "permissionsetextension", "controladdin", "profile", "entitlement", "dotnet",
)

_TOKEN = re.compile(
    r"(?P<comment>//[^\r\n]*|/\*.*?(?:\*/|\Z))|(?P<string>'(?:[^'\r\n]|'')*'?)|(?P<quoted>\"[^\"\r\n]*\"?)|(?P<number>\d+(?:\.\d+)?)|(?P<word>[^\W\d]\w*)|(?P<op>:=|\+=|-=|\*=|/=|::|<>|<=|>=|\.\.|[^\s\w])",
    re.S,
)
_OPENERS, _CLOSERS = {"begin", "case"}, {"end"}


@dataclass(slots=True)
class Token:
    kind: str
    text: str
    start: int
    end: int

    @property
    def low(self) -> str:
        return self.text.lower()


@dataclass
class Member:
    kind: str
    name: str
    is_local: bool
    signature: str
    start: int
    end: int
    body_start: int | None
    body_end: int | None
    attributes: list[str]
    doc_comment: str
    text: str


@dataclass
class AlObject:
    kind: str
    object_id: int | None
    name: str
    start: int
    end: int
    text: str
    properties: dict[str, str] = field(default_factory=dict)
    members: list[Member] = field(default_factory=list)

    @property
    def is_test(self) -> bool:
        return next((v for k, v in self.properties.items() if k.lower() == "subtype"), "").strip().lower() == "test"

    @property
    def head(self) -> str:
        """The object up to its first member."""
        cut = min((m.start for m in self.members), default=self.end) - self.start
        return self.text[:cut].rstrip() + "\n"


def tokens(src: str, comments: bool = False) -> list[Token]:
    return [Token(m.lastgroup, m.group(), m.start(), m.end()) for m in _TOKEN.finditer(src) if comments or m.lastgroup != "comment"]


@lru_cache(16)
def known_tokens(src: str) -> list[Token]:
    """The tokens of a text that is looked at several times; not to be changed."""
    return tokens(src)


@lru_cache(16)
def known_members(src: str) -> list[Member]:
    """The members of a text that is searched several times; not to be changed."""
    return [m for o in objects(src) for m in o.members]


def _match(toks: list[Token], i: int, open_: str, close: str) -> int:
    """Index after the bracket that closes the one at i; the end where none does."""
    depth = 0
    for j in range(i, len(toks)):
        depth += (toks[j].text == open_) - (toks[j].text == close)
        if depth == 0:
            return j + 1
    return len(toks)


def block_end(toks: list[Token], i: int) -> int:
    """Index after the end that closes the begin at i; the end of the tokens where none does."""
    depth = 0
    for j in range(i, len(toks)):
        if toks[j].kind == "word" and not (j and toks[j - 1].text in (".", "::")):
            depth += (toks[j].low in _OPENERS) - (toks[j].low in _CLOSERS)
            if depth == 0:
                return j + 1
    return len(toks)


def objects(src: str) -> list[AlObject]:
    """The objects of a file with their members, in order. Text that is no object gives none."""
    toks = tokens(src)
    lead = _comments_above(src)
    out, i = [], 0
    while i < len(toks):
        t = toks[i]
        if t.kind == "word" and t.low in OBJECT_KINDS:
            j = i + 1
            number = None
            if j < len(toks) and toks[j].kind == "number":
                number, j = int(float(toks[j].text)), j + 1
            name = toks[j].text.strip('"') if j < len(toks) and toks[j].kind in ("quoted", "word") else ""
            while j < len(toks) and toks[j].text != "{":
                j += 1
            if j < len(toks):
                stop = _match(toks, j, "{", "}")
                end = toks[stop - 1].end
                obj = AlObject(t.low, number, name, t.start, end, src[t.start : end])
                _fill(obj, src, toks[j + 1 : stop], lead)
                out.append(obj)
                i = stop
                continue
        i += 1
    return out


def _fill(obj: AlObject, src: str, toks: list[Token], lead: dict[int, str]) -> None:
    i, depth = 0, 0
    attributes: list[str] = []
    attr_start: int | None = None
    while i < len(toks):
        t = toks[i]
        if t.text == "[" and depth == 0:
            j = _match(toks, i, "[", "]")
            attributes.append(src[t.start : toks[j - 1].end])
            attr_start = t.start if attr_start is None else attr_start
            i = j
            continue
        if t.kind == "word" and t.low in ("procedure", "trigger"):
            first = i
            while first and toks[first - 1].low in ("local", "internal", "protected"):
                first -= 1
            i = _member(obj, src, toks, first, i, attributes, lead, attr_start)
            attributes, attr_start = [], None
            continue
        if t.text in "{}":
            depth += 1 if t.text == "{" else -1
        elif depth == 0 and t.kind == "word" and i + 1 < len(toks) and toks[i + 1].text == "=":
            j = i + 2
            while j < len(toks) and toks[j].text != ";":
                j += 1
            obj.properties[t.text] = src[toks[i + 1].end : toks[j].start if j < len(toks) else toks[-1].end].strip()
            i = j
        if t.low not in ("local", "internal", "protected"):
            attributes, attr_start = [], None
        i += 1


def _member(obj, src, toks, first, i, attributes, lead, attr_start) -> int:
    name = toks[i + 1].text.strip('"') if i + 1 < len(toks) else ""
    j = i + 2
    if j < len(toks) and toks[j].text == "::":  # a trigger of a control
        name += "::" + toks[j + 1].text.strip('"')
        j += 2
    if j < len(toks) and toks[j].text == "(":
        j = _match(toks, j, "(", ")")
    while j < len(toks) and toks[j].low not in ("var", "begin", ";", "}", "procedure", "trigger", "local", "internal", "protected") and toks[j].text != "[" or j < len(toks) and toks[j].text == "[" and toks[j - 1].kind == "word":
        j = _match(toks, j, "[", "]") if toks[j].text == "[" else j + 1
    sig_end = toks[j - 1].end
    start = toks[first].start
    k = j + 1 if j < len(toks) and toks[j].text == ";" else j
    if k < len(toks) and toks[k].low == "var":
        while k < len(toks) and toks[k].low not in ("begin", "procedure", "trigger", "}"):
            k += 1
    body_start = body_end = None
    end = sig_end
    if k < len(toks) and toks[k].low == "begin":
        stop = block_end(toks, k)
        if stop < len(toks) and toks[stop].text == ";":
            stop += 1
        body_start, body_end = toks[k].start, toks[stop - 1].end
        end, j = body_end, stop
    is_local = any(toks[x].low in ("local", "internal", "protected") for x in range(first, i))
    doc = lead.get(attr_start if attr_start is not None else start, "")
    obj.members.append(Member(toks[i].low, name, is_local, src[start:sig_end], start, end, body_start, body_end, attributes, doc, src[start:end]))
    return max(j, i + 1)


def _comments_above(src: str) -> dict[int, str]:
    """Offset of a token -> the comments directly above it (no gap with a blank line)."""
    out, held, at = {}, [], 0
    for t in tokens(src, comments=True):
        gap = src[at : t.start].count("\n") if at else 0
        if t.kind == "comment":
            if gap > 1 or (at and gap == 0 and not held):
                held = []
            if gap > 0 or not at or held:
                held.append(t.text)
        else:
            if held and gap <= 1:
                out[t.start] = "\n".join(held)
            held = []
        at = t.end
    return out


def signature_key(signature: str) -> str:
    """A signature without case and blanks, to tell overloads apart."""
    return re.sub(r"\s+", "", signature).lower()


def find_member(src: str, name: str, signature: str | None = None) -> Member | None:
    """The member of that name; among overloads the one with that signature, else the first; null if there is none."""
    found = [m for m in known_members(src) if m.name.lower() == name.strip('"').lower()]
    exact = [m for m in found if signature is not None and signature_key(m.signature) == signature_key(signature)]
    return next(iter(exact or found), None)


def splice(src: str, member: Member, text: str) -> str:
    """The source with another text in the member's place."""
    return src[: member.start] + text + src[member.end :]


def with_object_id(text: str, number: int) -> str:
    """An object's text under another id: only the id of its first declaration changes."""
    toks = tokens(text)
    for a, b in zip(toks, toks[1:]):
        if a.kind == "word" and a.low in OBJECT_KINDS and b.kind == "number":
            return text[: b.start] + str(number) + text[b.end :]
    return text


def wrapped(text: str, number: int = 50000) -> tuple[str, int]:
    """A text that is no object inside one, and by how many lines that shifts it."""
    first = next((t for t in tokens(text)), None)
    if first is not None and first.low in OBJECT_KINDS:
        return text, 0
    return f'codeunit {number} "Wrapper"\n{{\n{text}\n}}\n', 2
