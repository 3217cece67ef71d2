"""Leaf blocks of HTML pages: runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

# Element names of the HTML standard.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What these hold is never text of the page, and is not read.
HIDDEN_TAGS = frozenset("applet iframe noframes noscript script style svg template textarea title".split())
# Controls, and media with what stands in for them. They are read, as their end is often
# missing: what they hold is taken out when it comes.
CONTROL_TAGS = frozenset("audio button canvas datalist object select video".split())
# An opening tag ends these open elements, if no element of the second set lies between.
ENDED_BY = {
    **{tag: ({"p"}, {"td", "th", "li", "div", "section", "article"}) for tag in BLOCK_TAGS},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
}
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # (tag, parts of its names), outermost first
    link_chars: int
    label: int | None  # of the nearest ancestor that states one


class LeafBlocks(HTMLParser):
    """``blocks`` of one page. Never fails: unknown markup is passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...], int | None]] = []
        self.parts: list[str] = []
        self.link_chars = 0
        self.in_link = False
        # Hidden elements that are open, and block-level ones opened in them.
        self.hidden: list[str] = []
        self.within: list[str] = []
        # Controls that are open: place among the open elements, and blocks before them.
        self.controls: list[tuple[int, int]] = []

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def unknown_decl(self, data: str) -> None:
        pass

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            label = next((x for _, _, x in reversed(self.open) if x is not None), None)
            path = tuple((tag, names) for tag, names, _ in self.open)
            self.blocks.append(Block(text, path, self.link_chars, label))
        self.parts, self.link_chars = [], 0

    def end_open(self, at: int) -> None:
        """The open elements from ``at`` on end. Controls among them had no end of their
        own: their first words go, and the blocks after these stay, as the page's own."""
        while self.controls and self.controls[-1][0] >= at:
            place, before = self.controls.pop()
            kept = [b for b in self.blocks[before:] if len(b.path) != place + 1]
            for block in kept:
                block.path = block.path[:place] + block.path[place + 1 :]
            self.blocks[before:] = kept
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.hidden:
            if tag == self.hidden[-1] and tag not in ("script", "style", "title", "textarea"):
                self.hidden.append(tag)
            elif tag in BLOCK_TAGS and tag not in VOID_TAGS:
                self.within.append(tag)
            return
        if tag in BLOCK_TAGS:
            self.flush()
            if self.open and self.open[-1][0] in ("select", "datalist"):
                self.end_open(len(self.open) - 1)
            ended, held = ENDED_BY[tag]
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] in ended:
                    self.end_open(at)
                elif self.open[at][0] in held or self.open[at][0] in CONTROL_TAGS:
                    break
            if tag not in VOID_TAGS:
                names, label = [], None
                for key, value in attrs:
                    if key in ("class", "id", "role", "aria-label") and value:
                        names += [part.lower() for part in NAME_PARTS.findall(value)]
                    elif key == "data-label":
                        label = int(value == "1")
                self.open.append((tag, tuple(names), label))
        elif tag in HIDDEN_TAGS:
            self.hidden.append(tag)
        elif tag in CONTROL_TAGS:
            self.flush()
            self.controls.append((len(self.open), len(self.blocks)))
            self.open.append((tag, (), None))
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.in_link = True

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID_TAGS or tag in BLOCK_TAGS:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag == self.hidden[-1]:
                self.hidden.pop()
                self.within = self.within if self.hidden else []
                return
            if tag in self.within:
                while self.within.pop() != tag:
                    pass
                return
            if not any(name == tag for name, _, _ in self.open):
                return
            self.hidden, self.within = [], []  # an element around it ends: its own end is missing
        if tag in BLOCK_TAGS:
            self.flush()
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == tag:
                    self.end_open(at)
                    break
        elif tag in CONTROL_TAGS:
            self.flush()
            for place, before in reversed(self.controls):
                if self.open[place][0] == tag:
                    del self.blocks[before:]
                    self.end_open(place)
                    break
        elif tag == "a":
            self.in_link = False

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.in_link:
                self.link_chars += len(data)


def leaf_blocks(html: str | None) -> list[Block]:
    """Blocks in page order; none for NULL, empty and textless pages."""
    if not html:
        return []
    parser = LeafBlocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    parser.end_open(0)
    return parser.blocks
