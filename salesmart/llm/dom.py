"""Web pages as trees of blocks with one row of features per node; runs inside tasks."""

from __future__ import annotations

import html
import math
import re

import numpy as np

from salesmart.llm.tasks import ship

# Kinds of HTML elements.
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
SKIPPED = frozenset("head template svg canvas object select button datalist option math audio video map".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_SAME = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
    "thead": ("table",), "tbody": ("table",), "tfoot": ("table",),
}
ROW_PARTS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody"), "tfoot": ("thead", "tbody")}
P_SCOPE = frozenset("td th table button caption object html".split())
CONTROLS = frozenset("input select textarea button label fieldset".split())

# Words in class, id, role and similar attributes that tell what a container is for.
TOKEN_GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip topbar sitemap submenu dropdown",
    "header": "header masthead logo branding hero tagline",
    "footer": "footer foot copyright legal colophon imprint contentinfo",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular teaser teasers complementary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion outbrain taboola commercial",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall toast warning banner",
    "comment": "comment comments reply replies discussion disqus respond responses review reviews thread feedback commentlist",
    "form": "form search searchbox login signin contact poll survey register",
    "share": "share sharing social follow",
    "content": "content article post entry story body main text hentry prose articlebody maincontent",
}
TAG_GROUPS = ["p", "h1 h2 h3 h4 h5 h6", "ul ol li dl dt dd menu", "table tbody thead tfoot tr td th", "div", "section", "article main", "nav",
              "header", "footer", "aside", "form fieldset", "blockquote pre figure figcaption", "#text"]
SEMANTIC = ["article main", "nav", "header", "footer", "aside", "form fieldset"]

#: What it costs to leave a node to its children, and how likely a node must be to stay alone.
MIXED_COST, LIKELY = 2.0, 0.3

_GROUP_OF = {word: n for n, words in enumerate(TOKEN_GROUPS.values()) for word in words.split()}
_TAG_GROUP = {tag: n for n, tags in enumerate(TAG_GROUPS) for tag in tags.split()}
_SEMANTIC = {tag: n for n, tags in enumerate(SEMANTIC) for tag in tags.split()}
_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S
)
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|aria-label|data-role|data-y)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I)
_VALUES = re.compile(r""""[^"]*+"|'[^']*+'""")
_NO_DISPLAY = re.compile(r"""style\s*=\s*(?:"[^"]*|'[^']*)display\s*:\s*none""", re.I)
_WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE_END = re.compile(r"[.!?。！？](?=\s|$)")


def hidden(attributes: str) -> bool:
    if "hidden" in attributes and "hidden" in _VALUES.sub('""', attributes).split():
        return True
    return "display" in attributes and bool(_NO_DISPLAY.search(attributes))


class Page:
    """A page's block elements and text leaves; a parent comes before its children, and nodes stand in page order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes, self.labels = ["html"], [-1], [""], [None]
        self.texts: list[str | None] = [None]
        self.link_chars, self.controls = [0], [0]
        self._run, self._linked = [], 0
        self._open: dict[str, int] = {}  # how many elements of a kind are open
        self._read(source)

    def _node(self, tag: str, parent: int, attributes: str, text: str | None = None, links: int = 0) -> int:
        label = self.labels[parent]
        if "data-y" in attributes:
            label = {m[1].lower(): m[2] or m[3] or m[4] for m in _ATTRIBUTE.finditer(attributes)}.get("data-y") == "1"
        for column, value in zip(
            (self.tags, self.parents, self.attributes, self.labels, self.texts, self.link_chars, self.controls),
            (tag, parent, attributes, label, text, links, 0),
        ):
            column.append(value)
        return len(self.tags) - 1

    def _flush(self, block: int) -> None:
        """End a run of inline text; it becomes a leaf of the block it stands in."""
        if self._run:
            text = " ".join(html.unescape("".join(self._run)).split())
            if text:
                self._node("#text", block, "", text, min(self._linked, len(text)))
        self._run, self._linked = [], 0

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # open elements with their block nodes
        skipping, at, match = 0, 0, None  # depth of the stack below which text is left out
        while at < len(source):
            match = _TOKEN.search(source, at)
            text = source[at : match.start() if match else len(source)]
            if text and not skipping:
                self._run.append(text)
                if self._open.get("a"):
                    self._linked += len(text)
            if not match:
                break
            at = match.end()
            closing, tag = match[1], (match[2] or "").lower()
            if not tag:
                continue
            if closing:
                skipping = self._close(stack, tag, skipping)
                continue
            attributes = match[3] or ""
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                if tag == "textarea":
                    self.controls[stack[-1][1]] += 1
                at = len(source) if end is None else end.start()
                close = source.find(">", at)
                at = len(source) if close < 0 else close + 1
                continue
            if tag in VOID:
                if tag in ("br", "hr", "img", "wbr") and not skipping:
                    if tag == "br":
                        self._run.append(" ")
                    elif tag == "hr":
                        self._flush(stack[-1][1])
                elif tag == "input":
                    self.controls[stack[-1][1]] += 1
                continue
            if tag not in INLINE:
                skipping = self._implied_ends(stack, tag, skipping)
            if tag in CONTROLS:
                self.controls[stack[-1][1]] += 1
            if stack[-1][0] == "head" and tag not in HEAD_ONLY:
                skipping = self._pop(stack, len(stack) - 1, skipping)
            if tag in ("html", "body"):
                self.attributes[0] += " " + attributes
                continue
            if attributes.endswith("/") and tag in SKIPPED:
                continue
            block = stack[-1][1]
            self._open[tag] = self._open.get(tag, 0) + 1
            if tag not in INLINE and not skipping:
                self._flush(block)
                block = self._node(tag, block, attributes)
            stack.append((tag, block))
            if not skipping and (tag in SKIPPED or hidden(attributes)):
                skipping = len(stack)
        self._flush(stack[-1][1])

    def _pop(self, stack: list, depth: int, skipping: int) -> int:
        """Close open elements down to ``depth``."""
        block = stack[-1][1]
        while len(stack) > depth:
            self._open[stack.pop()[0]] -= 1
        if stack[-1][1] != block:
            self._flush(block)
        return 0 if skipping > len(stack) else skipping

    def _close(self, stack: list, tag: str, skipping: int) -> int:
        if not self._open.get(tag):
            if tag in ("br", "p") and not skipping:
                self._flush(stack[-1][1])
            return skipping
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag:
                return self._pop(stack, depth, skipping)
            if tag in INLINE and stack[depth][0] not in INLINE:
                break  # an inline element does not end the blocks inside it
        return skipping

    def _implied_ends(self, stack: list, tag: str, skipping: int) -> int:
        """A block start ends an open paragraph; list items and table parts end their kind."""
        for depth in range(len(stack) - 1, 0, -1) if self._open.get("p") else ():
            if stack[depth][0] == "p":
                skipping = self._pop(stack, depth, skipping)
                break
            if stack[depth][0] in P_SCOPE:
                break
        same = ROW_PARTS.get(tag, (tag,))
        if tag in CLOSED_BY_SAME and any(self._open.get(kind) for kind in same):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in same:
                    return self._pop(stack, depth, skipping)
                if stack[depth][0] in CLOSED_BY_SAME[tag]:
                    break
        return skipping

    # features

    def features(self) -> np.ndarray:
        """(nodes, features): tag, attribute tokens, depth, subtree density, position and siblings of every node."""
        n = len(self.tags)
        parents, tags = self.parents, self.tags
        depth, articles = [0] * n, [0] * n
        semantic, own = [[0] * len(SEMANTIC) for _ in range(n)], [[0] * len(TOKEN_GROUPS) for _ in range(n)]
        above: list[list[int]] = [[0] * len(TOKEN_GROUPS) for _ in range(n)]
        sums = np.zeros((n, 12))
        children: list[list[int]] = [[] for _ in range(n)]
        position = 0
        start = [0] * n
        for v in range(n):
            up, tag = parents[v], tags[v]
            if up >= 0:
                depth[v], articles[v] = depth[up] + 1, articles[up]
                semantic[v], above[v] = semantic[up], above[up]
                children[up].append(v)
            if tag in _SEMANTIC:
                semantic[v] = [*semantic[v]]
                semantic[v][_SEMANTIC[tag]] = 1
                articles[v] += tag == "article"
            found = self._groups(v) if self.attributes[v] else ()
            if found:
                above[v] = [*above[v]]
                for group in found:
                    own[v][group] = above[v][group] = 1
            start[v] = position
            text = self.texts[v]
            if text is not None:
                position += len(text)
                words = text.count(" ") + 1
                sums[v, :5] = len(text), words, self.link_chars[v], len(_SENTENCE_END.findall(text)), 1
                sums[v, 11] = ("©" in text) + sum(map(str.isdigit, text[:80])) / 80
            else:
                sums[v, 5] = 1
                sums[v, 6], sums[v, 7] = tag == "p", tag == "li"
                sums[v, 8], sums[v, 9] = self.controls[v], tag in ("h1", "h2", "h3", "h4", "h5", "h6")
                sums[v, 10] = tag in ("article", "section")
        for v in range(n - 1, 0, -1):
            sums[parents[v]] += sums[v]
        chars = sums[:, 0]
        total = max(chars[0], 1.0)
        density = sums[:, 2] / np.maximum(chars, 1)
        per_leaf = sums[:, 1] / np.maximum(sums[:, 4], 1)
        up = np.maximum(np.array(parents), 0)
        logs = np.log1p(chars)
        around = np.zeros((n, 6))
        for group in children:
            size = len(group)
            if not size:
                continue
            mean_chars, mean_density = logs[group].mean(), density[group].mean()
            for at, v in enumerate(group):
                around[v] = size, at / size, mean_chars, mean_density, logs[group[at - 1]] if at else -1, logs[group[at + 1]] if at + 1 < size else -1
        starts = np.array(start) / total
        kinds = np.zeros((n, len(TAG_GROUPS)))
        for v, tag in enumerate(tags):
            if tag in _TAG_GROUP:
                kinds[v, _TAG_GROUP[tag]] = 1
        own_kinds = kinds[up] * (kinds[:, -1:] > 0)  # a text's block
        columns = [
            np.array(depth), logs, np.log1p(sums[:, 1]), density, sums[:, 3] / np.maximum(sums[:, 1], 1), per_leaf, 100 * sums[:, 5] / np.maximum(chars, 1),
            chars / total, starts, starts + chars / total, chars / np.maximum(chars[up], 1), density[up], per_leaf[up], logs[up],
            sums[:, 6] / np.maximum(sums[:, 4], 1), sums[:, 7] / np.maximum(sums[:, 4], 1), np.log1p(sums[:, 8]), sums[:, 9], np.log1p(sums[up, 8]),
            np.array(articles), sums[:, 10], sums[:, 11],
        ]
        return np.column_stack([*columns, around, kinds, own_kinds, np.array(semantic), np.array(own), np.array(above)]).astype(np.float32)

    def _groups(self, v: int) -> set[int]:
        found = set()
        for match in _ATTRIBUTE.finditer(self.attributes[v]):
            if match[1].lower() != "data-y":
                value = html.unescape(match[2] or match[3] or match[4] or "")
                for part in _WORD_PARTS.findall(value):
                    group = _GROUP_OF.get(part.lower())
                    if group is not None:
                        found.add(group)
        return found

    def main_share(self) -> np.ndarray:
        """Share of every node's characters that are labelled as main text (pages made for training)."""
        sizes, main = np.zeros(len(self.tags)), np.zeros(len(self.tags))
        for v, text in enumerate(self.texts):
            if text is not None:
                sizes[v], main[v] = len(text), len(text) * bool(self.labels[v])
        for v in range(len(self.tags) - 1, 0, -1):
            sizes[self.parents[v]] += sizes[v]
            main[self.parents[v]] += main[v]
        return main / np.maximum(sizes, 1)

    def decode(self, p: np.ndarray) -> list[bool]:
        """Keep or drop every node so that the choices agree along every path and the total log-probability is highest.

        A node is kept whole, dropped whole, or left to its children; the last is free of contradiction, since a
        child of a kept node is kept and one of a dropped node is dropped. Ties drop. Where all would go, the likeliest node
        stays if its probability is at least LIKELY.
        """
        n = len(self.tags)
        p = np.clip(p.astype(float), 1e-4, 1 - 1e-4)
        keep, drop = np.log(p).tolist(), np.log1p(-p).tolist()
        split = [(a + b) / 2 - MIXED_COST for a, b in zip(keep, drop)]
        best, choice = [0.0] * n, [0] * n
        for v in range(n - 1, -1, -1):
            whole_keep, whole_drop, mixed = keep[v], drop[v], split[v] + best[v]
            if self.texts[v] is not None:
                mixed = -math.inf
            top = max(whole_keep, whole_drop, mixed)
            choice[v] = 0 if top == whole_drop else 1 if top == whole_keep else 2
            up = self.parents[v]
            if up >= 0:
                keep[up] += whole_keep
                drop[up] += whole_drop
                best[up] += top
        kept = [False] * n
        for v in range(n):
            up = self.parents[v]
            if up >= 0 and choice[up] != 2:
                choice[v] = choice[up]
            kept[v] = choice[v] == 1
        if not any(kept) and p.max() >= LIKELY:
            # a page of a few words: its likeliest node, with all that is in it
            kept[int(p.argmax())] = True
            for v in range(1, n):
                kept[v] = kept[v] or kept[self.parents[v]]
        return kept

    def text(self, kept: list[bool]) -> str:
        return " ".join(text for text, keep in zip(self.texts, kept) if keep and text)


ship(__name__)
