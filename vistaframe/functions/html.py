"""Elements of an HTML page in one pass: tags are read from left to right onto a
stack of open elements. For use inside tasks, one page at a time."""

from __future__ import annotations

import html
import re
import sys
from typing import NamedTuple

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title".split())  # their content holds no tags
DECODED = frozenset("textarea title".split())  # of these, those whose content has character references
BLOCKS = ("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
          "hr main menu nav ol p pre section table ul").split()
# A start tag ends open elements of these names, unless one of the others lies between.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "option": (("option",), ("select", "datalist")), "td": (("td", "th"), ("tr", "table")),
        "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
        **{b: (("p",), ("button", "td", "th", "table", "caption")) for b in BLOCKS}}

_MARKUP = re.compile(
    r"<!--(?:>|.*?--!?>|.*\Z)"  # a comment, perhaps without its end
    r"|<[!?][^>]*>|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"
    r"""|<(?P<start>[a-zA-Z][^\s/><]*)(?P<attrs>(?:[^<>=]++|=\s*(?:"[^"]*"|'[^']*')|=)*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'][^\s=/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'][^\s]*)))?""")


class Rule(NamedTuple):
    """Elements ``tag`` that carry the class ``cls`` and stand directly in a
    ``parent``, where these are given."""
    kind: str
    tag: str
    cls: str | None = None
    parent: str | None = None


def attributes(text: str) -> dict[str, str]:
    """Names in lower case; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def elements(page: str, rules: list[Rule]) -> list[tuple[str, str, str]]:
    """``(kind, inner HTML, text)`` of the elements that a rule names, in the
    order of their start tags; several rules may name one element.

    Names count in any case, attributes in any order and quotes. Void elements
    hold nothing; what stands in comments, scripts and styles is no markup and
    (but for titles and text areas) no text. Missing end tags end with the
    element around them, at a start tag that ends them, or at the page's end;
    end tags of nothing are skipped. Text has its references decoded and runs of
    white space as one blank.
    """
    wanted: dict[str, list[Rule]] = {}
    for r in rules:
        wanted.setdefault(r.tag, []).append(r)
    stack: list[tuple] = []  # (tag, [(place in found, kind)], start of the content, number of texts before)
    count: dict[str, int] = {}
    texts: list[str] = []
    found: list = []

    def close(depth: int, end: int) -> None:
        while len(stack) > depth:
            tag, kinds, start, before = stack.pop()
            count[tag] -= 1
            for place, kind in kinds:
                found[place] = (kind, page[start:end], " ".join("".join(texts[before:]).split()))

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        texts.append(html.unescape(page[at:m.start() if m else len(page)]))
        if m is None:
            break
        at = m.end()
        if m["end"]:
            tag = m["end"].lower()
            if count.get(tag):
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), m.start())
        elif m["start"]:
            tag = m["start"].lower()
            ends, around = ENDS.get(tag, ((), ()))
            if any(count.get(e) for e in ends):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        close(k, m.start())
                        break
                    if stack[k][0] in around:
                        break
            kinds = []
            if tag in wanted:
                classes = attributes(m["attrs"]).get("class", "").split()
                parent = stack[-1][0] if stack else None
                for r in wanted[tag]:
                    if (r.cls is None or r.cls in classes) and r.parent in (None, parent):
                        kinds.append((len(found), r.kind))
                        found.append((r.kind, "", ""))
            if tag in VOID:
                continue
            stack.append((tag, kinds, at, len(texts)))
            count[tag] = count.get(tag, 0) + 1
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                stop = end.start() if end else len(page)
                if tag in DECODED:
                    texts.append(html.unescape(page[at:stop]))
                at = stop
    close(0, len(page))
    return found
