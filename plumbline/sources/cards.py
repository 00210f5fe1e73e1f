"""Cards of a directory page, by the standard HTML parser."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

_LIKES = re.compile(r"([\d,]+)\s+likes?", re.I)
_COMMENTS = re.compile(r"([\d,]+)\s+comments?", re.I)
_LINK = re.compile(r"/software/([a-z0-9-]+)/?(?:about/?)?$")


class _Cards(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: dict[str, dict[str, list[str]]] = {}
        self.now, self.heading, self.hidden, self.all = "", 0, 0, []

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("script", "style"):
            self.hidden += 1
        link = _LINK.search(dict(attrs).get("href") or "") if tag == "a" else None
        if link:
            self.now = link[1]
            self.found.setdefault(self.now, {"name": [], "text": []})
            self.heading += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1
        if tag == "a" and self.heading:
            self.heading -= 1
        if tag in ("li", "article"):
            self.now = ""

    def handle_data(self, data: str) -> None:
        if self.hidden or not data.strip():
            return
        self.all.append(data.strip())
        if self.now:
            self.found[self.now]["name" if self.heading else "text"].append(data.strip())


def _count(pattern: re.Pattern[str], text: str) -> int | None:
    m = pattern.search(text)
    return int(m[1].replace(",", "")) if m else None


def cards(seed: str, html: str) -> list[tuple[str, str, str, str, str, str]]:
    """(source_slug, ext_id, url, title, body, metadata) of each alternative to a seed, then of the page."""
    page = _Cards()
    page.feed(html)
    out = []
    for slug, part in page.found.items():
        if slug == seed:
            continue
        name, text = " ".join(part["name"]) or slug, " ".join(part["text"])
        meta = {"seed_software": seed, "likes": _count(_LIKES, text), "alt_slug": slug}
        out.append(("alternativeto", f"{seed}:{slug}", f"https://alternativeto.net/software/{slug}/", name, f"{name}. {text}".strip(), json.dumps(meta, sort_keys=True)))
    text = " ".join(page.all)
    meta = {"kind": "page", "seed_software": seed, "comment_count": _count(_COMMENTS, text), "alt_count": len(out)}
    out.append(("alternativeto", f"{seed}:__page__", f"https://alternativeto.net/software/{seed}/", seed, text, json.dumps(meta, sort_keys=True)))
    return out
