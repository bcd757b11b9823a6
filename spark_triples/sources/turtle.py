"""Turtle for the whole-file route: bytes of one file in, triples out, one at a time."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urljoin

from spark_triples.schema import ANYURI, LANG_STRING, RDF_TYPE, XSD, XSD_STRING

# --- Fixed format: Turtle tokens, and the RDF collection vocabulary ----------
_TOKEN = re.compile(
    r"""
    (?:\s++|\#[^\n\r]*+)*+
  (?:
    <(?P<iri>(?:[^\x00-\x20<>"{}|^`\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*)>
  | (?P<literal>\"{3}(?:\"{0,2}(?:[^"\\]|\\.))*+\"{3}
      |'{3}(?:'{0,2}(?:[^'\\]|\\.))*+'{3}
      |"(?:[^"\\\n\r]|\\.)*+"|'(?:[^'\\\n\r]|\\.)*+')
  | (?P<directive>@prefix\b|@base\b|(?i:prefix\b|base\b)(?=\s))
  | @(?P<lang>[A-Za-z]+(?:-[A-Za-z0-9]+)*)
  | (?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))
  | _:(?P<bnode>[\w:](?:[\w:·.-]*[\w:·-])?)
  | (?P<pname>(?:[^\W\d_](?:[\w.-]*[\w-])?)?:
      (?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-])
         (?:(?:[\w:.·-]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-])*
            (?:[\w:·-]|%[0-9A-Fa-f]{2}|\\[_~.!$&'()*+,;=/?\#@%-]))?)?)
  | (?P<word>true\b|false\b|a\b)
  | (?P<mark>\^\^|[.;,\[\]()])
  | (?P<end>\Z)
  )
    """,
    re.VERBOSE | re.DOTALL,
)
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)
_CHARACTERS = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}
_RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
# -----------------------------------------------------------------------------


def _unescape(text: str) -> str:
    def one(match: re.Match) -> str:
        code = match[1] or match[2]
        return chr(int(code, 16)) if code else _CHARACTERS.get(match[3], match[3])

    if "\\" not in text:
        return text
    # two \\u escapes may spell one character; half of such a pair is an error
    return _ESCAPE.sub(one, text).encode("utf-16", "surrogatepass").decode("utf-16")


def is_absolute(iri: str) -> bool:
    return re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", iri) is not None


def tokens(text: str, position: int = 0) -> Iterator[tuple[str, str]]:
    """(kind, text) of the tokens from a position on."""
    scanner = _TOKEN.scanner(text, position)
    while match := scanner.match():
        yield match.lastgroup, match[match.lastgroup]
        if match.lastgroup == "end":
            return
        position = match.end()
    raise ValueError(f"unexpected text: {text[position : position + 40]!r}")


class Document:
    """A Turtle file, or some whole statements of it with the prefixes and the base that hold there
    and a name for that part, which its own blank nodes carry."""

    def __init__(self, text: str, path: str, prefixes: dict[str, str] | None = None, base: str = "", part: str = ""):
        self.tokens = tokens(text)
        self.kind, self.text = next(self.tokens)
        self.prefixes = dict(prefixes or {})
        self.base, self.part = base, part
        self.scope = hashlib.sha256(path.encode()).hexdigest()
        self.made = 0
        self.pending: list[tuple] = []

    def take(self) -> tuple[str, str]:
        taken = self.kind, self.text
        if taken[0] != "end":
            self.kind, self.text = next(self.tokens)
        return taken

    def accept(self, text: str) -> bool:
        found = self.kind == "mark" and self.text == text
        if found:
            self.take()
        return found

    def expect(self, text: str) -> None:
        if not self.accept(text):
            raise ValueError(f"expected {text!r}, found {self.text!r}")

    def resolve(self, iri: str) -> str:
        iri = _unescape(iri)
        if is_absolute(iri):
            return iri
        if not self.base:
            raise ValueError(f"relative IRI without a base: {iri!r}")
        return urljoin(self.base, iri)

    def expand(self, name: str) -> str:
        prefix, local = name.split(":", 1)
        if prefix not in self.prefixes:
            raise ValueError(f"unknown prefix: {prefix!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def new_bnode(self) -> str:
        self.made += 1
        return f"_:{self.scope}--{self.part}{self.made}"

    def directive(self) -> None:
        keyword = self.take()[1]
        if keyword.lower().endswith("prefix"):
            prefix, colon, local = self.take()[1].partition(":")
            if not colon or local:
                raise ValueError(f"expected a prefix, found {prefix!r}")
            self.prefixes[prefix] = self.resolve(self.take()[1])
        else:
            self.base = self.resolve(self.take()[1])
        if keyword.startswith("@"):
            self.expect(".")

    def resource(self) -> str:
        """An IRI or a blank node; what a blank node holds is put in ``pending``."""
        if self.accept("["):
            node = self.new_bnode()
            if not self.accept("]"):
                self.properties(node)
                self.expect("]")
            return node
        if self.accept("("):
            items = []
            while not self.accept(")"):
                items.append(self.object())
            rest = _RDF + "nil"
            for item in reversed(items):
                node = self.new_bnode()
                self.pending.append((node, _RDF + "first", *item, None))
                self.pending.append((node, _RDF + "rest", rest, ANYURI, None, None))
                rest = node
            return rest
        if self.kind == "bnode":
            return f"_:{self.scope}-{self.take()[1]}"
        return self.iri()

    def iri(self) -> str:
        """An IRI, whole or with a prefix: all that a predicate or a datatype may be."""
        kind, text = self.take()
        if kind == "iri":
            return self.resolve(text)
        if kind == "pname":
            return self.expand(text)
        raise ValueError(f"expected a term, found {text!r}")

    def object(self) -> tuple[str, str, str | None]:
        """(text, type, language)"""
        if self.kind == "literal":
            quoted = self.take()[1]
            width = 3 if quoted[:3] in ('"""', "'''") else 1
            text = _unescape(quoted[width:-width])
            if self.kind == "lang":
                return text, LANG_STRING, self.take()[1]
            if self.accept("^^"):
                return text, self.iri(), None
            return text, XSD_STRING, None
        if self.kind == "number":
            text = self.take()[1]
            name = "decimal" if "." in text else "integer"
            return text, XSD + ("double" if "e" in text.lower() else name), None
        if self.kind == "word" and self.text != "a":
            return self.take()[1], XSD + "boolean", None
        return self.resource(), ANYURI, None

    def properties(self, subject: str) -> None:
        while True:
            if self.kind == "word" and self.text == "a":
                self.take()
                predicate = RDF_TYPE
            else:
                predicate = self.iri()
            while True:
                self.pending.append((subject, predicate, *self.object(), None))
                if not self.accept(","):
                    break
            while (more := self.accept(";")) and self.text == ";":
                pass
            if not more or (self.kind == "mark" and self.text in ".]"):
                return

    def triples(self) -> Iterator[tuple]:
        while self.kind != "end":
            if self.kind == "directive":
                self.directive()
                continue
            only_bnode = self.kind == "mark" and self.text == "["
            subject = self.resource()
            if not (only_bnode and self.kind == "mark" and self.text == "."):
                self.properties(subject)
            self.expect(".")
            yield from self.pending
            self.pending.clear()


def parse_turtle(content: bytes, path: str) -> Iterator[tuple]:
    """Triples of a Turtle file as (subject, predicate, object, type, language, context).

    Blank-node labels are made unique per file. Only the statement at hand is held.
    """
    return Document(content.decode("utf-8-sig"), path).triples()
