"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes; each is content or not. Node potentials come from
the tag, the words of class, id and role, the length of the text and its share of links;
parent-child potentials from how often content lies in content. Messages pass up and down the
tree (sum-product) and give each node's marginal; the text of nodes above one half is kept.

The potentials are counted on labelled pages: a few pages with marks in this module and a
bounded sample of the given pages, labelled where they name their parts by the elements of
the standard (article, main, nav, aside and so on) or by usual labels of other parts. Each labelled page counts once more
without these names and labels, so that lengths and links bear weight of their own.

Cases: a null or empty page has the text ''; a page of text without elements is content if the
model finds so; every row gets its own result; an empty table gives an empty one; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.dom import Page
from gaugeflow.llm.words import map_slices

# Elements of the standard that say what they hold.
NAMED_MAIN = frozenset(["article", "main"])
NAMED_OTHER = frozenset(["nav", "aside", "header", "footer", "form", "dialog", "menu", "button", "fieldset"])

_PROSE = (
    "The river had been rising for days before anyone in the lower town took notice of it, and by then the old "
    "bridge was already under water.",
    "Nobody could say later who had opened the gate, but all agreed that the animals were found on the hill.",
    "In the second part of this account we look at the letters and at what they say about the family.",
    "Short answer: yes.",
    "A list of the instruments follows, with the years in which each was bought and the name of its maker.",
    "They left before noon and did not come back.",
    "It rained on the second day, and on the third day too.",
    "The house stood empty for a year; then the roof fell in.",
)
_OTHER = (
    '<{a} class="{c}"><p>We use cookies to give you the best experience. Accept or read more about it here.</p></{a}>',
    '<{a} id="{c}"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact</a></li></ul></{a}>',
    '<{a} class="{c}"><h3>Related</h3><p><a href="/x">Ten more stories that you may like to read today</a></p></{a}>',
    '<{a} class="{c}">Buy now and save half the price on all garden chairs this week only.</{a}>',
    '<{a} class="{c}"><div class="{c}"><p>Great piece, thank you for writing this. I had no idea that it was so.</p></div></{a}>',
    '<{a} class="{c}"><h1><a href="/">The Paper</a></h1><h2>News of the town</h2></{a}>',
    '<{a} class="{c}"><h2>Site</h2>For all readers</{a}>',
    '<{a} class="{c}"><form><label>Mail</label><input name="m"><button>Subscribe</button></form></{a}>',
)
# Label words that page templates use for parts beside the main text.
_OTHER_LABELS = (
    "ad ads advert advertisement banner promo sponsor sponsored cookie notice consent alert popup modal newsletter "
    "subscribe signup nav navbar menu breadcrumb breadcrumbs sidebar side widget related recommended header masthead "
    "top footer bottom copyright legal share social comments comment reply respond discussion login search form "
    "pagination pager tags toolbar").split()
_OTHER_SET = frozenset(_OTHER_LABELS)
_MAIN_LABELS = "content main article post entry body story text".split()


def labelled_pages() -> list[str]:
    """Pages in which data-part says main or other for an element and what it holds."""
    pages = []
    for i, word in enumerate(_OTHER_LABELS):
        parts = []
        for k in range(4):
            tag = ("section", "header", "div", "aside", "nav", "footer")[(i + k) % 6]
            label = word if k == 0 else _OTHER_LABELS[(7 * i + k) % len(_OTHER_LABELS)]
            part = _OTHER[(i + k) % len(_OTHER)].format(a=tag, c=label)
            parts.append(part.replace(f"<{tag} ", f"<{tag} data-part='other' ", 1))
        prose = "".join(f"<p>{_PROSE[(i + k) % len(_PROSE)]}</p>" for k in range(4))
        lists = "<ul><li>Two brass horns, 1871</li><li>One drum of unknown make</li></ul>" if i % 3 == 0 else ""
        quote = f"<blockquote>{_PROSE[i % 3]}</blockquote>" if i % 4 == 0 else ""
        inner = parts[3] if i % 2 else ""
        main = (f'<div class="{_MAIN_LABELS[i % len(_MAIN_LABELS)]}" data-part="main"><h1>A title of some words</h1>'
                f"{prose}{inner}<h2>The letters</h2>{lists}{quote}<p>{_PROSE[i % len(_PROSE)]}</p></div>")
        pages.append(f"<html><body>{parts[0]}{parts[1]}{main}{parts[2]}</body></html>")
    return pages


def _state_by_mark(page: Page, node: int) -> int | None:
    attrs = page.attributes[node]
    return 1 if 'data-part="main"' in attrs else 0 if "data-part='other'" in attrs else None


def _state_by_name(page: Page, node: int) -> int | None:
    tag = page.tags[node]
    if tag in NAMED_MAIN:
        return 1
    return 0 if tag in NAMED_OTHER or _OTHER_SET.intersection(page.labels[node]) else None


def _amount(text: int) -> int:
    """Steps of the length of an element's own text."""
    return sum(text >= step for step in (1, 25, 80, 200))


def states(page: Page, named) -> list[int]:
    """Each node's label: that of the nearest labelled element around it, else other."""
    out = [0] * len(page.tags)
    for node in range(1, len(out)):
        own = named(page, node)
        out[node] = out[page.parents[node]] if own is None else own
    return out


def features(page: Page, anonymous: bool = False) -> list[list[str]]:
    """Features of each node, some of them over all that it holds."""
    n = len(page.tags)
    text, links = page.text[:], page.links[:]
    for node in range(n - 1, 0, -1):
        text[page.parents[node]] += text[node]
        links[page.parents[node]] += links[node]
    out = []
    for node in range(n):
        tag = page.tags[node]
        if anonymous and (tag in NAMED_MAIN or tag in NAMED_OTHER):
            tag = "div"
        own = [f"tag {tag}", f"own {_amount(page.text[node])}",
               f"links {round(4 * links[node] / text[node]) if text[node] else 'none'}"]
        if not anonymous:
            own += [f"label {word}" for word in set(page.labels[node])]
        out.append(own)
    return out


@dataclass(frozen=True)
class TreeModel:
    """Log potentials: of each feature for content against other, of the root and of child
    state given parent state."""

    feature: dict[str, float]
    root: tuple[float, float]
    edge: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, page: Page) -> list[float]:
        """Probability of content for each node, by messages up and down the tree."""
        parents, n = page.parents, len(page.tags)
        (p00, p01), (p10, p11) = self.edge
        belief = [(1.0, math.exp(max(-30.0, min(30.0, sum(self.feature.get(f, 0.0) for f in own)))))
                  for own in features(page)]
        up: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for node in range(n - 1, 0, -1):
            b0, b1 = belief[node]
            m0, m1 = p00 * b0 + p01 * b1, p10 * b0 + p11 * b1
            scale = m0 + m1
            up[node] = m0, m1 = m0 / scale, m1 / scale
            q0, q1 = belief[parents[node]]
            q0, q1 = q0 * m0, q1 * m1
            scale = q0 + q1
            belief[parents[node]] = q0 / scale, q1 / scale
        b0, b1 = belief[0][0] * self.root[0], belief[0][1] * self.root[1]
        out = [b1 / (b0 + b1)] * n
        for node in range(1, n):
            parent = parents[node]
            q1 = out[parent]
            # what the parent says without this child's own message
            u0, u1 = up[node]
            q0, q1 = (1 - q1) / max(u0, 1e-300), q1 / max(u1, 1e-300)
            d0, d1 = q0 * p00 + q1 * p10, q0 * p01 + q1 * p11
            b0, b1 = belief[node]
            out[node] = b1 * d1 / (b0 * d0 + b1 * d1)
        return out

    def main_text(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        if not page.runs:
            return ""
        kept = self.marginals(page)
        return "\n".join(text for node, text in page.runs if kept[node] > 0.5)


def count_page(page: Page, labels: list[int], counts: Counter) -> None:
    for anonymous in (False, True):
        for node, own in enumerate(features(page, anonymous)):
            if node:
                for feature in own:
                    counts[feature, labels[node]] += 1
                counts["edge", labels[page.parents[node]], labels[node]] += 1
                counts["node", labels[node]] += 1


def train(
    pages: DataFrame, html: str = "html", sample_rows: int = 500, mark_weight: int = 4, page_id: str = "page_id",
    most_features: int = 20_000,
) -> TreeModel:
    """Count on the marked pages (each `mark_weight` times) and on about `sample_rows` of the
    given pages, drawn by hash of id and page, that name a main part and another part. Of their
    features, the `most_features` most frequent are kept."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(html).cast("string").alias("html")).filter(
        F.col("html").isNotNull())
    share = min(1.0, sample_rows / max(rows.count(), 1))
    sample = rows.filter(F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 32)) < int(share * (1 << 32))).select("html")

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                page = Page(body)
                names = {_state_by_name(page, node) for node in range(len(page.tags))}
                if {0, 1} <= names:
                    count_page(page, states(page, _state_by_name), counts)
        if counts:
            yield pa.RecordBatch.from_pydict(
                {"key": ["\t".join(map(str, k)) for k in counts], "n": list(counts.values())})

    counts: Counter = Counter()
    # label words of the sample may be many: only those on two nodes or more
    found = (
        sample.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
        .filter("n > 1").orderBy(F.desc("n"), "key").limit(most_features).collect()
    )
    for row in found:
        *name, state = row.key.split("\t")
        counts[(*name[:1], *(int(x) for x in name[1:]), int(state))] += row.n
    for body in labelled_pages():
        page = Page(body)
        own: Counter = Counter()
        count_page(page, states(page, _state_by_mark), own)
        for key, n in own.items():
            counts[key] += n * mark_weight
    return fit(counts)


def fit(counts: Counter) -> TreeModel:
    total = [counts["node", 0] + 1, counts["node", 1] + 1]
    names = {k[0] for k in counts if len(k) == 2 and k[0] != "node"}
    feature = {
        name: math.log((counts[name, 1] + 0.5) / total[1]) - math.log((counts[name, 0] + 0.5) / total[0])
        for name in sorted(names)}

    def edge(parent: int) -> tuple[float, float]:
        n = [counts["edge", parent, child] + 1 for child in (0, 1)]
        return n[0] / sum(n), n[1] / sum(n)

    return TreeModel(feature, (0.9, 0.1), (edge(0), edge(1)))


def extract(
    pages: DataFrame, model: TreeModel, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [shared.value.main_text(body) for body in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return map_slices(rows, "html", work, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
