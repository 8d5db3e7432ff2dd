"""Cell texts of one calendar page: the helper that runs in Python workers."""

from __future__ import annotations

import re
from html import unescape

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("template",))
_SLOTS = {"span": ("day", "num"), "ul": ("schedule2",)}
_TOKEN = re.compile(
    r"<(?P<raw>script|style)\b.*?</(?P=raw)\s*>|<!--.*?-->|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_ONCLICK = re.compile(r"\bonclick\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_DATE_LINK = re.compile(r"date=\d{8}")


def _value(pattern: re.Pattern, attrs: str) -> str:
    found = pattern.search(attrs)
    return unescape(found[found.lastindex]) if found else ""


def page_cells(html: str) -> list[tuple[str, str, str, str]]:
    """(day, number, species text, date link) of each table cell that has a day and a number.

    The first matching element anywhere inside a cell counts.  An end tag closes
    everything that was opened after its start tag; a stray one is ignored.
    """
    stack: list[tuple[str, dict | None, int]] = []
    cells: list[dict] = []
    inside: list[dict] = []  # open cells
    sinks: list[list[str]] = []  # text lists of open elements that are collected
    opened: dict[str, int] = {}  # how often a tag is on the stack
    silent = 0
    end = 0

    def collect(start: int, stop: int) -> None:
        text = unescape(html[start:stop]).strip()
        if text:
            for sink in sinks:
                sink.append(text)

    for token in _TOKEN.finditer(html):
        if sinks and not silent and token.start() > end:
            collect(end, token.start())
        end = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["close"]:
            if opened.get(tag):
                while True:
                    name, cell, added = stack.pop()
                    opened[name] -= 1
                    if cell is not None:
                        inside.pop()
                    if added:
                        del sinks[-added:]
                    silent -= name in _SILENT
                    if name == tag:
                        break
            continue
        added = 0
        if inside and tag in _SLOTS:
            classes = _value(_CLASS, token["attrs"]).split()
            for slot in _SLOTS[tag]:
                if slot in classes:
                    for outer in inside:
                        if slot not in outer:
                            outer[slot] = parts = []
                            sinks.append(parts)
                            added += 1
        elif inside and tag == "a":
            onclick = _value(_ONCLICK, token["attrs"])
            if _DATE_LINK.search(onclick):
                for outer in inside:
                    outer.setdefault("onclick", onclick)
        cell = None
        if tag == "td":
            cell = {}
            cells.append(cell)
        if tag in _VOID or token["attrs"].endswith("/"):
            del sinks[len(sinks) - added :]
            continue
        if cell is not None:
            inside.append(cell)
        silent += tag in _SILENT
        stack.append((tag, cell, added))
        opened[tag] = opened.get(tag, 0) + 1
    if sinks and not silent:
        collect(end, len(html))
    return [
        (
            "".join(c["day"]),
            "".join(c["num"]),
            " ".join(c.get("schedule2", ())),
            c.get("onclick", ""),
        )
        for c in cells
        if "day" in c and "num" in c
    ]
