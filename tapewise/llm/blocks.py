"""Leaf blocks of an HTML page and their features, by one tolerant pass over its tags."""

from __future__ import annotations

import html
import re

from tapewise.llm.common import by_value

#: Elements by role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas select button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var".split())
#: An opening tag of the first kind closes an open element of the second (end tags that may be left out).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                     "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop|aria-label|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]{2,}")
_BLANK = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    __slots__ = ("text", "tags", "names", "linked", "chars")

    def __init__(self, text: str, tags: tuple, names: tuple, linked: int, chars: int):
        self.text, self.tags, self.names, self.linked, self.chars = text, tags, names, linked, chars


def _names(attributes: str) -> tuple:
    """Words of an element's class, id, role and the like."""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return ()
    words = []
    for key, value in _ATTR.findall(attributes):
        if key.lower() == "hidden":
            words.append("hidden")
        words += _NAME.findall(_CAMEL.sub(" ", value).lower())
    return tuple(words)


def leaf_blocks(page: str) -> list[Block]:
    """Text between block-level tags, in page order, with the tags and names of its ancestors.

    Character references are decoded, white space runs become one space; a cut-off tag at the end is dropped.
    """
    stack: list[tuple[str, tuple]] = []
    out: list[Block] = []
    parts: list[str] = []
    linked = anchors = 0
    at = 0

    def flush():
        nonlocal linked
        if parts:
            text = _BLANK.sub(" ", "".join(parts)).strip()
            if text:
                block_tags = tuple(t for t, _ in stack if t not in INLINE)
                names = tuple(n for _, ns in stack for n in ns)
                out.append(Block(text, block_tags, names, linked, len(text)))
            parts.clear()
        linked = 0

    def add(raw: str):
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if anchors:
                linked += len(text.strip())

    def close(number: int):
        nonlocal anchors
        for name, _ in stack[number:]:
            anchors -= name == "a"
        del stack[number:]

    size = len(page)
    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if not found.group(4):  # cut off inside a tag
            break
        if found.group(1):
            numbers = [i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name]
            if not numbers:
                if name in ("p", "br"):
                    flush() if name == "p" else parts.append(" ")
                continue
            if name not in INLINE:
                flush()
            elif any(t not in INLINE for t, _ in stack[numbers[0] + 1:]):
                continue  # an inline end tag does not close blocks
            close(numbers[0])
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(page, at)
            if name not in ("script", "style", "svg", "math", "canvas"):
                flush()
            at = end.end() if end else size
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name not in INLINE:
            flush()
            shut = CLOSES.get(name, ())
            for i in range(len(stack) - 1, -1, -1):
                tag = stack[i][0]
                if tag == "p" and name in CLOSES_P or tag in shut:
                    close(i)
                    break
                if tag in ("ul", "ol", "table", "div", "article", "section", "body", "dl", "td", "main", "aside"):
                    break
        if found.group(3).rstrip().endswith("/") and name not in INLINE and name not in CLOSES_P:
            continue
        anchors += name == "a"
        stack.append((name, _names(found.group(3))))
    flush()
    return out


def _size(n: int) -> str:
    return str(min(7, max(0, n.bit_length() - 2)))


def features(blocks: list[Block]) -> list[list[str]]:
    """Ancestor-tag and text features of each block, with some of its neighbours'."""
    own = []
    for b in blocks:
        tags = [t for t in b.tags if t not in ("html", "body")]
        rows = ["bias", "leaf=" + (tags[-1] if tags else "none"), "words=" + _size(b.text.count(" ") + 1)]
        rows += {"in=" + t for t in tags}
        rows += {"name=" + n for n in b.names}
        share = b.linked / b.chars
        rows.append("links=" + ("none" if share == 0 else "some" if share < 0.5 else "most"))
        rows.append("ends" if b.text[-1] in ".!?\"'»”…:;" else "open")
        if b.text[0] in "©" or "©" in b.text[:200]:
            rows.append("copyright")
        if not any("in=" + t in rows for t in ("article", "main", "nav", "footer", "aside", "header")):
            rows.append("no-landmark")
        own.append(rows)
    out = []
    for i, rows in enumerate(own):
        near = [f"{side}:{f}" for side, j in (("<", i - 1), (">", i + 1)) if 0 <= j < len(own) for f in own[j][1:3]]
        out.append(rows + near + (["first"] if i == 0 else []) + (["last"] if i == len(own) - 1 else []))
    return out


by_value(__name__)
