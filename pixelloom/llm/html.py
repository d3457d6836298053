"""Reading HTML in one pass: whatever a page holds, time is linear in its length.

A hidden element (script, style, ..) reaches from its opening to the first closing tag of its name, a comment to ``-->``; one that is
never closed hides nothing.  A tag reaches from a ``<`` to the next ``>``; a ``<`` without one is text.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

#: Elements of which nothing is seen, and those whose text is no language.
HIDDEN, CODE = ("script", "style", "head", "template", "noscript"), ("script", "style")
_TITLE, _TITLE_END = re.compile(r"(?ia)<title\b"), re.compile(r"(?ia)</title\s*>")
_HTML, _LANG = re.compile(r"(?ia)<html\b"), re.compile(r"(?ia)\slang\s*=\s*[\"']?([a-z-]+)")


@functools.cache
def _patterns(names: tuple[str, ...]) -> tuple[re.Pattern, dict[str, re.Pattern]]:
    close = {name: re.compile(rf"(?ia)</{name}\s*>") for name in names}
    return re.compile(rf"(?ia)<({'|'.join(names)})\b|<!--|<!doctype\b"), close | {"<!--": re.compile("-->"), "<!doctype": re.compile(">")}


def without_hidden(html: str, names: tuple[str, ...] = HIDDEN) -> str:
    """The page with a space for each element of these names, comment and document type."""
    opening, closing = _patterns(names)
    out, done, at = [], 0, 0
    unclosed = set()  # looked for once: nothing after this place closes them
    while found := opening.search(html, at):
        name = (found[1] or found[0]).lower()
        end = None if name in unclosed else closing[name].search(html, found.end())
        if end is None:
            unclosed.add(name)
            at = found.end()
        else:
            out += [html[done : found.start()], " "]
            done = at = end.end()
    return "".join([*out, html[done:]])


def parts(html: str) -> Iterator[tuple[str, str | None]]:
    """(text, the tag after it without its brackets, or null if none follows) in order."""
    *closed, rest = html.split(">")
    for piece in closed:
        text, less, tag = piece.partition("<")
        yield (text, tag) if less else (text + ">", None)
    yield rest, None


def words_of(html: str) -> str:
    """The text, titles too, with a space for each tag."""
    return "".join(text if tag is None else text + " " for text, tag in parts(without_hidden(html, CODE)))


def title(html: str) -> str | None:
    start = _TITLE.search(html)
    begin = html.find(">", start.end()) if start else -1
    end = _TITLE_END.search(html, begin + 1) if begin >= 0 else None
    return html[begin + 1 : end.start()] if end else None


def language(html: str) -> str | None:
    """The lang attribute of the first html tag."""
    start = _HTML.search(html)
    end = html.find(">", start.end()) if start else -1
    found = _LANG.search(html, start.end(), end) if end >= 0 else None
    return found[1] if found else None
