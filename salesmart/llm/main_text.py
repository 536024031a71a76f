"""Main text of web pages: boosted trees over features of DOM nodes, decoded along the tree.

The model learns here, from a bounded sample of the table's own pages whose markup says what is main text (``article`` or
``main``) and what is not. So that it does not rest on that markup, the labelled texts are laid out anew in
many ways: other containers, with and without telling names, with sidebars, notices, adverts, forms and reader comments between
and around them. Every page is then read whole, each node gets a probability, and keeping or dropping is decided for all
nodes of the tree together, so that no node is kept below a dropped one or dropped below a kept one.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmart.llm import dom, kernels, trees
from salesmart.llm.tasks import ship, tidy

#: The model learns from at most this many pages of at most so many characters, chosen by hash, each laid out a few times.
SAMPLE_PAGES, SAMPLE_CHARS, LAYOUTS = 200, 60_000, 3
CHUNK_BYTES = 1 << 22
_OUTSIDE = ("nav", "header", "footer", "aside", "form")

# Texts that stand around an article on many pages.
MENU = "Home|About|About us|Contact|News|Sport|World|Business|Culture|Login|Sign in|Search|Sitemap|RSS|Help|Archive|Blog|Products|Shop|Team".split("|")
NOTICES = [
    "We use cookies to improve your experience. By using this site you agree to our cookie policy.",
    "This site uses cookies.", "Accept all cookies", "Subscribe to our newsletter and never miss a story.", "Sign up for our weekly newsletter",
    "Your privacy matters to us. Manage your consent settings here.", "You have read all your free articles this month. Subscribe now.",
]
FOOTERS = ["© {} All rights reserved.", "Copyright {}. All rights reserved. Terms of use. Privacy policy.", "Imprint | Privacy | Terms", "Powered by {}"]
FIELDS = ["Name", "Email", "E-mail address", "Your message", "Password", "Search", "Website", "Comment"]
SHARES = ["Share", "Tweet", "Share on Facebook", "Email", "Print", "Follow us"]
NAMES = "anna|Bob|carl77|Dora K.|emil|F. Gray|guest|Hanna|ivo|J. Smith|kate|Leo".split("|")


def sample(pages: DataFrame, most: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[str]:
    """At most ``most`` pages with telling markup, whichever way the table is split; repeated pages count once."""
    told = F.lower("html").rlike("<(article|main)[\\s>]") & (F.length("html") <= chars)
    marked = pages.where(told).select(F.xxhash64("html").alias("key"), "html")
    keys = [row.key for row in marked.select("key").distinct().orderBy("key").limit(most).collect()]
    if not keys:
        return []
    # only the chosen pages travel; of equal pages each task sends one
    some = marked.where(F.col("key") <= keys[-1]).groupBy("key").agg(F.min("html").alias("html")).orderBy("key").collect()
    return [row.html for row in some]


def told(source: str) -> tuple[list[tuple[str, str]], list[tuple[str, bool]]]:
    """(tag, text) of the main blocks that the markup marks, and (text, is link) of those it marks as something else."""
    page = dom.Page(source)
    inside, outside = [], []
    where: list[str] = []
    for v, tag in enumerate(page.tags):
        up = page.parents[v]
        place = "main" if tag in ("article", "main") else "out" if tag in _OUTSIDE else where[up] if up >= 0 else ""
        where.append("out" if up >= 0 and where[up] == "out" else place)
        text = page.texts[v]
        if text and where[v] == "main":
            inside.append((page.tags[up], text))
        elif text:
            outside.append((text, page.link_chars[v] * 2 > len(text)))
    return inside, outside


class Layout:
    """One random layout of a page's texts; main text carries data-y=1, everything else data-y=0."""

    def __init__(self, rng: random.Random, inside: list[tuple[str, str]], outside: list[tuple[str, bool]], words: list[str]):
        self.rng, self.inside, self.words = rng, inside, words
        self.links = [text for text, link in outside if link] or MENU
        self.rest = [text for text, link in outside if not link]
        self.named = rng.random() < 0.6  # whether containers tell what they are

    def phrase(self, low: int, high: int) -> str:
        count = self.rng.randint(low, high)
        at = self.rng.randrange(max(1, len(self.words) - count))
        text = " ".join(self.words[at : at + count])
        return text + self.rng.choice(["", ".", "."])

    def attributes(self, group: str, main: int) -> str:
        rng = self.rng
        mark = f' data-y="{main}"'
        if self.named and rng.random() < 0.8:
            word = rng.choice(dom.TOKEN_GROUPS[group].split())
            name = rng.choice([word, f"{word}-{rng.choice(['box', 'wrap', 'list', 'inner', 'container'])}", f"site-{word}", f"{word} c{rng.randint(1, 99)}"])
        else:
            name = rng.choice(["c", "col", "row", "wrap", "inner", "box", "x"]) + rng.choice(["", "-1", "-8", str(rng.randint(1, 99))])
        if rng.random() < 0.25:
            return mark
        return f' {rng.choice(["class", "class", "id"])}="{name}"{mark}'

    def wrap(self, tags: list[str], group: str, body: str, main: int = 0) -> str:
        tag = self.rng.choice(tags) if self.named else self.rng.choice(["div", tags[-1]])
        return f"<{tag}{self.attributes(group, main)}>{body}</{tag}>"

    def link_list(self, texts: list[str]) -> str:
        links = [f'<a href="/{n}">{html.escape(text)}</a>' for n, text in enumerate(texts)]
        if self.rng.random() < 0.6:
            return "<ul>" + "".join(f"<li>{link}</li>" for link in links) + "</ul>"
        return self.rng.choice([" ", " | ", "<br>", " &middot; "]).join(links)

    def menu(self) -> str:
        count = self.rng.randint(2, 9)
        return self.wrap(["nav", "nav", "div"], "menu", self.link_list([self.rng.choice(self.links + MENU) for _ in range(count)]))

    def header(self) -> str:
        body = f"<{(tag := self.rng.choice(['div', 'h1', 'p', 'span']))}>{html.escape(self.phrase(1, 4))}</{tag}>"
        return self.wrap(["header", "div"], "header", body + (self.menu() if self.rng.random() < 0.5 else ""))

    def footer(self) -> str:
        body = f"<p>{html.escape(self.rng.choice(FOOTERS).format(self.phrase(1, 2)))}</p>" if self.rng.random() < 0.6 else html.escape(self.rng.choice(self.rest or FOOTERS))
        return self.wrap(["footer", "div"], "footer", body + (self.menu() if self.rng.random() < 0.4 else ""))

    def side(self) -> str:
        body = f"<h3>{html.escape(self.phrase(1, 4))}</h3>" + self.link_list([self.phrase(2, 9) for _ in range(self.rng.randint(2, 6))])
        if self.rng.random() < 0.5:
            body += f"<p>{html.escape(self.phrase(5, 25))}</p>"
        return self.wrap(["aside", "aside", "div", "section"], "side", body)

    def advert(self) -> str:
        text = html.escape(self.rng.choice(self.rest) if self.rest and self.rng.random() < 0.5 else self.phrase(3, 15))
        return self.wrap(["div", "aside", "section"], "advert", self.rng.choice([text, f"<p>{text}</p>", f'<a href="/x">{text}</a>', f"<p>Advertisement</p><p>{text}</p>"]))

    def notice(self) -> str:
        text = self.rng.choice(NOTICES) if self.rng.random() < 0.5 else self.phrase(5, 25)
        return self.wrap(["div", "section", "div"], "notice", f"<p>{html.escape(text)}</p>" + self.rng.choice(["", "<button>OK</button>", '<a href="/p">More</a>']))

    def form(self) -> str:
        fields = "".join(f"<label>{text}</label><input name=f>" for text in self.rng.sample(FIELDS, self.rng.randint(1, 4)))
        return self.wrap(["form", "form", "div"], "form", f"<p>{html.escape(self.phrase(2, 8))}</p>{fields}<button>Send</button>")

    def share(self) -> str:
        return self.wrap(["div", "ul"], "share", self.link_list(self.rng.sample(SHARES, self.rng.randint(2, 5))))

    def comments(self) -> str:
        rng = self.rng
        out = [f"<{(tag := rng.choice(['h2', 'h3', 'p']))}>{rng.choice(['Comments', 'Reader comments', '3 comments', 'Discussion', html.escape(self.phrase(1, 3))])}</{tag}>"]
        kind = rng.choice(["div", "li", "article", "section"])
        for _ in range(rng.randint(1, 6)):
            who = f"<{(tag := rng.choice(['span', 'b', 'div', 'p']))}>{rng.choice(NAMES)}</{tag}> {rng.choice(['', 'says:', '2 days ago', '12.03.2024 10:15', 'wrote'])}"
            out.append(f"<{kind}{self.attributes('comment', 0)}>{who}<p>{html.escape(self.phrase(4, 60))}</p>{rng.choice(['', '<a href=#r>Reply</a>'])}</{kind}>")
        body = "".join(out)
        return self.wrap(["section", "div", "ol", "div"], "comment", body + (self.form() if rng.random() < 0.4 else ""))

    def main(self) -> str:
        rng, blocks = self.rng, []
        plain = rng.choice(["p", "p", "p", "div", "br", "open"])
        texts = self.inside
        if rng.random() < 0.4 and len(texts) > 2:  # shorter articles, too
            texts = texts[: rng.randint(1, len(texts))]
        for n, (tag, text) in enumerate(texts):
            body = html.escape(text)
            if tag not in ("h1", "h2", "h3") and rng.random() < 0.15 and len(text) > 80:
                cut = body.find(" ", 40)
                body = f'{body[:cut]} <a href="/l">{rng.choice(["see here", "more on this", "source"])}</a>{body[cut:]}'
            if tag in ("h1", "h2", "h3"):
                blocks.append(f"<{tag}>{body}</{tag}>")
                continue
            if n and rng.random() < 0.08:
                blocks.append(f"<h{(level := rng.randint(2, 4))}>{html.escape(self.phrase(2, 7))}</h{level}>")
            chance = rng.random()
            if chance < 0.04:
                blocks.append(f"<blockquote><p>{body}</p></blockquote>")
            elif chance < 0.08:
                parts = [body[at : at + 120] for at in range(0, min(len(body), 600), 120)]
                blocks.append("<ul>" + "".join(f"<li>{part}</li>" for part in parts) + "</ul>")
            elif chance < 0.1:
                blocks.append(f"<table><tr><th>{html.escape(self.phrase(1, 2))}</th><td>{body[:200]}</td></tr></table>")
            elif chance < 0.12:
                blocks.append(f"<figure><img src=x><figcaption>{body[:150]}</figcaption></figure>")
            else:
                blocks.append({"p": f"<p>{body}</p>", "div": f"<div>{body}</div>", "br": f"{body}<br><br>", "open": f"<p>{body}"}[plain])
        if rng.random() < 0.3:
            blocks.insert(1, f'<p class="byline">By {rng.choice(NAMES)}, {rng.choice(["3 May 2024", "2 hours ago", "12/03/2023"])}</p>')
        for make in (self.advert, self.side, self.notice, self.share, self.form):
            if rng.random() < 0.15:
                blocks.insert(rng.randint(1, len(blocks)), make())
        body = "".join(blocks)
        for _ in range(rng.choice([0, 0, 1, 2])):
            body = f'<div{self.attributes("content", 1)}>{body}</div>'
        if rng.random() < 0.3:
            body += self.comments()
        return self.wrap(["article", "article", "main", "section", "div"], "content", body, 1)

    def page(self) -> str:
        rng = self.rng
        before = [make() for make, chance in ((self.header, 0.5), (self.menu, 0.8), (self.notice, 0.3), (self.advert, 0.5), (self.side, 0.2), (self.form, 0.15)) if rng.random() < chance]
        after = [make() for make, chance in ((self.share, 0.2), (self.comments, 0.35), (self.side, 0.4), (self.form, 0.2), (self.advert, 0.2), (self.notice, 0.2), (self.footer, 0.9)) if rng.random() < chance]
        rng.shuffle(before)
        middle = self.main()
        if rng.random() < 0.3:
            extra = self.side()
            middle = rng.choice([f'<div class="row">{extra}{middle}</div>', f'<div class="row">{middle}{extra}</div>'])
        body = "".join(before) + middle + "".join(after)
        return f'<html><body data-y="0">{body}</body></html>'


def layouts(sources: list[str], each: int = LAYOUTS, seed: int = 7) -> Iterator[str]:
    """The sampled pages as they are, marked by their own markup, and ``each`` random layouts of every one."""
    for n, source in enumerate(sources):
        inside, outside = told(source)
        if not inside:
            continue
        words = " ".join(text for _, text in inside).split()
        yield source
        for turn in range(each):
            yield Layout(random.Random(seed * 1_000_003 + n * 101 + turn), inside, outside, words).page()


def examples(sources: list[str], each: int = LAYOUTS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, main or not, and weight of every node with text. Nodes of mixed text weigh by how clearly one kind prevails."""
    x, y, weight = [], [], []
    for source in layouts(sources, each, seed):
        page = dom.Page(source)
        if "data-y" not in source:
            where = []
            for v, tag in enumerate(page.tags):
                up = page.parents[v]
                where.append(up >= 0 and where[up] or tag in ("article", "main"))
            page.labels = where
        features, share = page.features(), page.main_share()
        used = features[:, 1] > 0
        x.append(features[used])
        y.append(share[used] >= 0.5)
        weight.append(np.abs(2 * share[used] - 1))
    return np.concatenate(x), np.concatenate(y).astype(float), np.concatenate(weight)


def fit(pages: DataFrame) -> trees.Trees | None:
    """The model; None if no page tells by its markup what its main text is."""
    sources = [source for source in sample(pages) if told(source)[0]]
    return trees.fit(*examples(sources)) if sources else None


def main_texts(sources: list[str | None], model: trees.Trees | None) -> list[str]:
    """Main text of each page. Without a model all visible text outside of telling markup is kept."""
    pages = [dom.Page(source or "") for source in sources]
    if model is None:
        out = []
        for page in pages:
            inside = [False] * len(page.tags)
            for v in range(1, len(page.tags)):
                inside[v] = page.tags[v] in _OUTSIDE or inside[page.parents[v]]
            out.append(page.text([not value for value in inside]))
        return out
    features = [page.features() for page in pages]
    p = model.probability(np.concatenate(features)) if features else np.zeros(0)
    ends = np.cumsum([len(part) for part in features])
    return [page.text(page.decode(p[end - len(page.tags) : end])) for page, end in zip(pages, ends)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its code points for every row of ``pages``.

    Null and empty html and pages without main text give the empty string. Repeated rows give a row each and are one
    page for the model. Other columns play no part. An empty table gives no rows. Where no page marks its main
    text, the visible text outside nav, header, footer, aside and form is taken. Pages are read whole, whatever their length.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    shipped = spark.sparkContext.broadcast(fit(rows))  # some thousand numbers

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in (part for whole in batches for part in kernels.chunks(whole, "html", CHUNK_BYTES)):
            texts = main_texts(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(tidy(read), "page_id long, url string, text string, n_chars long")


ship(__name__)
