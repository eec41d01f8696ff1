"""Main text of web pages by wrapper induction: what stays the same on the pages of a host is its template."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import stored
from demandflow.llm.page_tree import FLOW, Page, Tree, tree_matching
from demandflow.operators.dimensions import checked_broadcast

# A slot's text is constant if this share of the host's different pages has the same.
CONSTANT = 0.5
# Inside an article it takes more, and at least so many different pages.
CONSTANT_INSIDE, PAGES_INSIDE = 0.8, 3
# The content is the deepest element that holds this share of the varying text; what varies beside it
# is a teaser or an advert.
CONTENT_SHARE = 0.85
# A block of which more than this share is links is a menu.
LINK_SHARE = 0.6
# Trees merged by one task at a time.
FAN_IN = 64

SLOT = "struct<pages:bigint,written:bigint,top:bigint,top_n:bigint,chars:bigint,links:bigint>"
WRAPPER = f"host string, shape string, slots array<{SLOT}>"


def host_of(url: Column) -> Column:
    """Lower-case host; pages without one are a host of their own, the empty string."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([^/?#:\s]+)", 1), F.lit("")))


def outlines(pages: DataFrame) -> DataFrame:
    """(host, page, shape, texts, chars, links) per row: the page's outline and, slot by slot, a hash of
    its text, its length and how much of it is links. ``pages`` has host and html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hosts, sources in _some(batch):
                out = [(host, *_outlined(source.as_py() or "")) for host, source in zip(hosts, sources)]
                kinds = [pa.string(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3]
                names = ["host", "page", "shape", "texts", "chars", "links"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    schema = "host string, page bigint, shape string, texts array<bigint>, chars array<bigint>, links array<bigint>"
    return pages.select("host", "html").mapInArrow(run, schema)


def _some(batch: pa.RecordBatch, rows: int = 200):
    """A batch by parts, so that what is built of them stays small."""
    for k in range(0, batch.num_rows, rows):
        part = batch.slice(k, rows)
        yield [part.column(0).to_pylist(), *part.columns[1:]]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def _outlined(source: str) -> tuple:
    page = Page(source)
    texts, chars, links = [[] for _ in range(page.size)], [0] * page.size, [0] * page.size
    for node, text, linked in page.blocks:
        texts[node.number].append(text)
        chars[node.number] += len(text)
        links[node.number] += linked
    return _hash(source), page.shape, [_hash("\n".join(t)) if t else None for t in texts], chars, links


def slot_counts(pages: DataFrame) -> DataFrame:
    """``WRAPPER`` rows, one per host and outline: over the host's different pages, how many have text in
    a slot, and the commonest text with its number of pages.

    Exact counts by aggregation: equal pages count once, a text in every page is one row per task.
    """
    outlined = pages.groupBy("host", "page").agg(F.first(F.struct("shape", "texts", "chars", "links")).alias("of")).select("host", "of.*")
    slots = outlined.select("host", "shape", F.posexplode(F.arrays_zip("texts", "chars", "links")).alias("slot", "of"))
    by_text = slots.groupBy("host", "shape", "slot", F.col("of.texts").alias("text")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("of.chars").alias("chars"), F.sum("of.links").alias("links")
    )
    there = F.col("text").isNotNull()
    top = F.max(F.when(there, F.struct("n", "text")))
    by_slot = by_text.groupBy("host", "shape", "slot").agg(
        F.sum("n").alias("pages"), F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).alias("written"),
        F.coalesce(top["text"], F.lit(0)).alias("top"), F.coalesce(top["n"], F.lit(0)).alias("top_n"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"),
    )
    row = F.struct("slot", F.struct("pages", "written", "top", "top_n", "chars", "links").alias("of"))
    ordered = F.transform(F.sort_array(F.collect_list(row)), lambda x: x["of"])
    return by_slot.groupBy("host", "shape").agg(ordered.alias("slots"))


class Wrapper(Tree):
    """A tree that grows by aligning others with it; slots add up."""

    def __init__(self, shape: str, slots: list):
        super().__init__(shape)
        self.slots = [tuple(s.values()) if isinstance(s, dict) else tuple(s) for s in slots]

    def merge(self, other: Wrapper) -> None:
        place = {j: i for i, j in tree_matching(self, other).items()}
        for j in range(len(other.labels)):
            if j in place:
                self.slots[place[j]] = _added(self.slots[place[j]], other.slots[j])
                continue
            up = place[other.parents[j]]
            place[j] = new = len(self.labels)
            self.labels.append(other.labels[j])
            self.slots.append(other.slots[j])
            self.kids.append([])
            self.parents.append(up)
            before = other.kids[other.parents[j]]
            before = before[: before.index(j)]
            self.kids[up].insert(self.kids[up].index(place[before[-1]]) + 1 if before else 0, new)

    def written(self) -> tuple[str, list]:
        slots = []

        def show(k: int) -> str:
            slots.append(self.slots[k])
            inner = " ".join([show(c) for c in self.kids[k]])
            return self.labels[k] + (f"({inner})" if inner else "")

        return show(0), slots


def _added(a: tuple, b: tuple) -> tuple:
    pages, written, top, top_n, chars, links = a
    if top == b[2]:
        top_n += b[3]
    elif (b[3], b[2]) > (top_n, top):
        top, top_n = b[2], b[3]
    return pages + b[0], written + b[1], top, top_n, chars + b[4], links + b[5]


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    trees = sorted(zip(rows["shape"], rows["slots"]), key=lambda x: (-x[1][0]["pages"], x[0]))
    base = Wrapper(*trees[0])
    for shape, slots in trees[1:]:
        base.merge(Wrapper(shape, slots))
    shape, slots = base.written()
    names = ["pages", "written", "top", "top_n", "chars", "links"]
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "shape": [shape], "slots": [[dict(zip(names, map(int, s))) for s in slots]]})


def wrappers(pages: DataFrame) -> DataFrame:
    """One ``WRAPPER`` row per host: all outlines of its pages aligned into one tree.

    A host's outlines are merged some at a time, in rounds, so that no task gets all of them.
    """
    trees = stored(slot_counts(outlines(pages)), "outlines")
    while True:
        per_host = trees.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / FAN_IN).cast("int").alias("parts"), F.count(F.lit(1)).alias("n"))
        most = per_host.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return trees
        dealt = trees.join(per_host, "host").withColumn("part", F.pmod(F.xxhash64("shape"), F.col("parts")))
        trees = stored(dealt.groupBy("host", "part").applyInPandas(_merge, WRAPPER), "wrappers")


def decide(shape: str, wrapper: Wrapper | None) -> list[bool]:
    """Which slots of an outline hold content, by the wrapper of its host."""
    page = Tree(shape)
    place = tree_matching(page, wrapper) if wrapper else {}
    slots = [wrapper.slots[place[k]] if k in place else (1, 1, 0, 1, 1, 0) for k in range(len(page.labels))]
    tags = [label.rstrip("!").split(".")[0] for label in page.labels]
    up = page.parents

    def within(names: set) -> list[bool]:
        inside = []
        for k in range(len(tags)):
            inside.append((up[k] >= 0 and inside[up[k]]) or tags[k] in names)
        return inside

    def dropped(inside: list[bool]) -> list[bool]:
        out = []
        for k, label in enumerate(page.labels):
            header = tags[k] == "header" and not inside[k]
            out.append((up[k] >= 0 and out[up[k]]) or label.endswith("!") or header)
        return out

    article = within({"article", "main"})
    gone = dropped(article)
    for names in ({"article"}, {"main"}):
        if any(tags[k] in names and not gone[k] for k in range(len(tags))):
            zone = within(names)
            return _inside(page, tags, [z and not g for z, g in zip(zone, gone)], slots)
    usable = [k for k in range(len(tags)) if not gone[k] and not _menu(slots[k])]
    constant = [_share(slots[k]) >= CONSTANT and slots[k][0] > 1 for k in range(len(tags))]
    varying = [k for k in usable if not constant[k]] or usable
    weight = [0.0] * len(tags)
    for k in varying:
        weight[k] = (slots[k][4] - slots[k][5]) / max(slots[k][0], 1)
    below = weight[:]
    for k in range(len(tags) - 1, 0, -1):
        below[up[k]] += below[k]
    root = 0
    while True:
        deeper = [k for k in page.kids[root] if below[k] >= CONTENT_SHARE * below[0] > 0 and tags[k] not in FLOW]
        if not deeper:
            break
        root = deeper[0]
    zone = []
    for k in range(len(tags)):
        zone.append(k == root or (up[k] >= 0 and zone[up[k]]))
    kept = set(varying)
    heading = [tags[k] == "h1" and k in kept and slots[k][0] > 1 for k in range(len(tags))]
    return [(z and k in kept) or h for k, (z, h) in enumerate(zip(zone, heading))]


def _share(slot: tuple) -> float:
    return slot[3] / slot[1] if slot[1] else 0.0


def _menu(slot: tuple) -> bool:
    return slot[4] > 0 and slot[5] > LINK_SHARE * slot[4]


def _inside(page: Tree, tags: list, keep: list[bool], slots: list) -> list[bool]:
    """Inside an article all stays but boxes that are the same on nearly every page while it varies."""
    def constant(k: int) -> bool:
        return slots[k][0] >= PAGES_INSIDE and _share(slots[k]) >= CONSTANT_INSIDE

    text = [k for k in range(len(tags)) if keep[k] and slots[k][4]]
    heaviest = max(text, key=lambda k: slots[k][4], default=None)
    if heaviest is None or constant(heaviest):
        return keep
    steady = [constant(k) or not slots[k][4] for k in range(len(tags))]
    for k in range(len(tags) - 1, 0, -1):
        steady[page.parents[k]] &= steady[k]
    out = keep[:]
    for k in range(1, len(tags)):
        boxed = tags[k] not in FLOW and tags[k] not in ("article", "main") and steady[k]
        out[k] &= out[page.parents[k]] or not keep[page.parents[k]]
        out[k] &= not boxed
    return out


@lru_cache(maxsize=4096)
def _decided(shape: str, known: tuple | None) -> list[bool]:
    return decide(shape, Wrapper(*known) if known else None)


def main_text(source: str, known: tuple | None) -> str:
    """Kept blocks of a page in order; ``known`` is its host's wrapper as (shape, slots), hashable."""
    page = Page(source)
    keep = _decided(page.shape, known)
    return " ".join([text for node, text, _ in page.blocks if keep[node.number]])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: id, url, host, text, n_chars.

    Pages are read as trees of blocks. The outlines of a host's pages are aligned by simple tree
    matching into one tree, its wrapper, whose slots know how often their commonest text occurs on the
    host's different pages. Slots that hold one text are template, varying ones content; of those the
    article (or else the element that holds most varying text) is taken, without parts whose tag, role
    or class names a menu, header, footer, sidebar, notice, advert, form or comments, and without lists
    of links. Every page takes part, hot hosts by partial counts; only the wrappers, one row per host,
    meet the pages again, by broadcast if measured to be small and by a join on the host otherwise.

    Null and empty pages, and pages without content, give an empty text. Rows are not merged, also where
    ids repeat or are null; a null or unreadable url puts a page on the host with the empty name, a host
    of one page is judged by tags and names alone. Pages may be of any length and depth (elements more
    than 100 deep count as text of the hundredth). An empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    known = stored(wrappers(rows), "hosts").select("host", F.struct("shape", "slots").alias("wrapper"))
    met = rows.join(checked_broadcast(known), "host", "left").select("wrapper", "html", "id", "url", "host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        for batch in batches:
            hosts = batch.column(4).to_pylist()
            texts = []
            for k, host in enumerate(hosts):
                if host not in held:
                    if len(held) > 2000:
                        held.clear()
                    wrapper = batch.column(0)[k].as_py()
                    held[host] = (wrapper["shape"], tuple(tuple(s.values()) for s in wrapper["slots"])) if wrapper else None
                texts.append(main_text(batch.column(1)[k].as_py() or "", held[host]))
            columns = [*batch.columns[2:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "host", "text", "n_chars"])

    kind = rows.schema["id"].dataType.simpleString()
    return met.mapInArrow(run, f"id {kind}, url string, host string, text string, n_chars bigint")
