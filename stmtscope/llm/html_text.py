"""Main text of web pages by consensus of each host's pages.

Every page scores its containers: a block of text counts for the container it stands in, half
as much for the next one out, and so on; link text does not count; containers marked as
content count double, those marked as menus, adverts, comments and the like not at all.
The page votes for the generalised path of its best container (tags with their first class
or id, digits as ``0``).  Votes are added up per host in Spark, and every page is read
again with its host's winning paths: the first one, and those of other templates, which are the paths that
at least one page in twenty voted for.  One of these is taken if it holds more than twice the text of the
first.  A page in which all of them are empty falls back to its own best one.

A name marks a menu, an advert and the like only if it does not say that something has or lacks one
(``has-sidebar``), and not on a container that holds an article or, in a page without any, most of its text.  A
page of which nothing is left is read without regard to names.

Winning paths meet the pages by a join on host.  Hosts with more than one page in
``HEAVY_HOSTS`` are fewer than that many, so their paths are broadcast, and their pages are
dealt evenly instead of by host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.url_filter import host_and_path
from stmtscope.operators.staging import checkpointed

HEAVY_HOSTS = 1000
TEMPLATES = 20  # of a host: paths with at least one vote in so many

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <[!?][^>]*(?:>|\Z)
      | <(/?)([a-zA-Z][^\s/><]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>
      | </?[a-zA-Z][^<>]*(?:>|\Z|(?=<))
    """,
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
CONTAINERS = frozenset(
    "html body div article section main nav header footer aside form table td th dialog fieldset figure".split()
)
# Start or end of any of these ends the block before it.
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote address hr tr tbody thead tfoot caption figcaption "
    "details summary title option".split()
)
RAW = frozenset("script style textarea template noscript iframe svg select button object canvas title".split())
SKIPPED_TAGS = frozenset("nav footer aside dialog head".split())
SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu sidebar aside footer cookie cookies consent notice notices popup modal overlay comment comments discussion "
    "disqus replies respond share sharing social related recommended newsletter subscribe subscription login signup "
    "breadcrumb breadcrumbs pagination pager toolbar masthead topbar widget skip form search".split()
)
# Parts of a name that says something about a page instead of naming a part of it.
STATES = frozenset("has have no not with without is enabled disabled on off show hide hidden layout page".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
CONTENT_NAMES = frozenset("article post entry story content main text body".split())
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_WEIGHT = 2.2


class Page:
    """Containers and text blocks of one page, in page order.

    ``step`` is a container's last part of its path; whole paths are never kept, so a deep page takes
    no more room than its text.
    """

    def __init__(self, source: str):
        self.parent = [-1]
        self.step = [""]
        self.weight = [1.0]
        self.hidden = [False]  # it or a container around it is no content for sure
        self.named = [False]  # its own name says so
        self.has_content = [False]  # an article is in it
        self.in_content = [False]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters outside links
        self._read(source)
        self.skipped = self._skipped()
        if self.blocks and not any(not self.skipped[c] and plain for c, _, plain in self.blocks):
            self.skipped = self.hidden

    def _open(self, tag: str, attributes: str, at: int) -> int:
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        label = values.get("class", "").split()[:1] or values.get("id", "").split()[:1]
        tokens = [re.findall("[a-z]+", t) for t in f"{values.get('class', '')} {values.get('id', '')}".lower().split()]
        names = {name for parts in tokens if not STATES & set(parts) for name in parts}
        content = tag in CONTENT_TAGS or bool(names & CONTENT_NAMES)
        plain = tag not in ("html", "body") and tag not in CONTENT_TAGS
        hidden = (
            tag in SKIPPED_TAGS
            or values.get("role", "").lower() in SKIPPED_ROLES - {"form"}
            or bool(re.search(r"(^|\s)hidden(\s|$|=)", re.sub("\"[^\"]*\"|'[^']*'", "", attributes)))
            or values.get("aria-hidden", "").lower() == "true"
            or "display:none" in values.get("style", "").replace(" ", "").lower()
        )
        named = (
            tag == "form"
            or values.get("role", "").lower() == "form"
            or (plain and bool(names & SKIPPED_NAMES))
            # A header belongs to the text only inside an article.
            or (plain and not content and not self.in_content[at] and (tag == "header" or "header" in names))
        )
        self.parent.append(at)
        self.step.append(tag + ("." + re.sub("[0-9]+", "0", label[0]).replace("/", "|") if label else ""))
        self.weight.append(CONTENT_WEIGHT if content and tag not in ("html", "body") else 1.0)
        self.hidden.append(hidden or self.hidden[at])
        self.named.append(named)
        self.has_content.append(False)
        self.in_content.append(self.in_content[at] or (content and plain) or tag in CONTENT_TAGS)
        if tag in CONTENT_TAGS and not self.hidden[-1]:
            while at >= 0 and not self.has_content[at]:
                self.has_content[at] = True
                at = self.parent[at]
        return len(self.step) - 1

    def _skipped(self) -> list[bool]:
        """Containers whose text does not count."""
        size = [0] * len(self.step)
        for container, _, plain in self.blocks:
            if not self.hidden[container]:
                size[container] += plain
        for i in range(len(size) - 1, 0, -1):
            size[self.parent[i]] += size[i]
        skipped = list(self.hidden)
        for i in range(1, len(size)):
            most = not self.has_content[0] and 2 * size[i] > size[0]
            named = self.named[i] and not self.has_content[i] and not most
            skipped[i] = skipped[i] or named or skipped[self.parent[i]]
        return skipped

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        opened: Counter[str] = Counter()  # containers in the stack, by tag
        parts: list[str] = []
        links, linked, end = 0, 0, 0

        def flush() -> None:
            nonlocal linked
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                self.blocks.append((stack[-1][1], text, max(0, len(text) - linked)))
            parts.clear()
            linked = 0

        def close(tag: str) -> None:
            """Leave the innermost container of this tag, and those in it."""
            while opened[tag]:
                name, _ = stack.pop()
                opened[name] -= 1
                if name == tag:
                    break

        position = 0
        while True:
            match = TOKEN.search(source, position)
            begin = match.start() if match else len(source)
            if begin > end and not self.hidden[stack[-1][1]]:
                parts.append(source[end:begin])
                if links:
                    linked += begin - end
            if not match:
                break
            position = end = match.end()
            tag = (match[2] or "").lower()
            if not tag:
                continue
            closing = match[1] == "/"
            if tag in RAW and not closing:
                if not match[3].endswith("/"):
                    close_tag = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(source, end)
                    position = end = close_tag.end() if close_tag else len(source)
                continue
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            elif tag == "br":
                parts.append(" ")
            if tag in BLOCKS:
                flush()
                links = 0
            if tag == "head" or tag in CONTAINERS:
                if closing:
                    close(tag)
                    continue
                if tag == "body":
                    close("head")  # an open head ends here
                stack.append((tag, self._open(tag, match[3], stack[-1][1])))
                opened[tag] += 1
        flush()

    def _path(self, container: int) -> str:
        steps = []
        while container > 0:
            steps.append(self.step[container])
            container = self.parent[container]
        return "".join(f"/{step}" for step in reversed(steps))

    def best_path(self) -> str | None:
        # Containers of one path share a number.
        number, numbers = [0], {}
        for i in range(1, len(self.step)):
            number.append(numbers.setdefault((number[self.parent[i]], self.step[i]), i))
        score: Counter[int] = Counter()
        for container, _, plain in self.blocks:
            if self.skipped[container]:
                continue
            share = float(plain)
            while container >= 0 and share >= 1:
                score[number[container]] += share * self.weight[container]
                share /= 2
                container = self.parent[container]
        if not score:
            return None
        most = max(score.values())
        return min(self._path(n) for n, s in score.items() if s == most)

    def text(self, path: str | None) -> str:
        """Blocks inside the containers with this path, joined by blank lines."""
        if path is None:
            return ""
        steps = path.split("/")[1:]
        depth, inside = [0], [not steps]  # how many steps lead to a container, -1 if others do
        for i in range(1, len(self.step)):
            up = self.parent[i]
            at = depth[up]
            fits = 0 <= at < len(steps) and self.step[i] == steps[at]
            depth.append(at + 1 if fits else -1)
            inside.append(inside[up] or (fits and at + 1 == len(steps)))
        return "\n\n".join(text for container, text, _ in self.blocks if inside[container] and not self.skipped[container])

    def main_text(self, paths: list[str] | None) -> str:
        """Text by the host's paths, the first of them unless another holds twice as much."""
        texts = [self.text(path) for path in paths or []]
        if texts:
            longest = max(texts, key=len)
            chosen = longest if len(longest) > 2 * len(texts[0]) else texts[0]
            if chosen:
                return chosen
        return self.text(self.best_path())


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: Counter[tuple[str, str | None]] = Counter()
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            votes[host, Page(source).best_path() if source else None] += 1
        hosts, paths = zip(*votes) if votes else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes.values(), pa.int64())],
            names=["host", "path", "votes"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for paths, source in zip(batch.column("paths").to_pylist(), batch.column("html").to_pylist()):
            texts.append(Page(source).main_text(paths) if source else "")
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """Every row of ``pages`` (``page_id``, ``url``, ``html``; other columns are ignored) with
    its main ``text`` and ``n_chars``.

    Null or blank html gives an empty text.  Pages with a null URL, or one without ``://``,
    share the empty host.  Blocks are decoded, trimmed, have single spaces, and are joined
    by two line ends in page order.  Of paths with equal votes the smallest wins.
    """
    host, _ = host_and_path(F.col("url"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    ballots = checkpointed(
        pages.select("host", "html")
        .mapInArrow(_votes, "host string, path string, votes long")
        .groupBy("host", "path")
        .agg(F.sum("votes").alias("votes"))
    )
    # Pages without any text have no path to vote for, but count for the size of their host.
    ballot = F.when(F.col("path").isNotNull(), F.struct((-F.col("votes")).alias("votes"), "path"))
    sizes = ballots.groupBy("host").agg(F.sum("votes").alias("n"), F.min(ballot).alias("x"))
    # At most TEMPLATES paths of a host have that share of its votes.
    often = (
        ballots.join(sizes, "host")
        .where((F.col("votes") > 1) & (F.col("votes") * TEMPLATES >= F.col("n")))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(ballot)).getField("path").alias("often"))
    )
    paths = F.array_distinct(F.concat(F.array("x.path"), F.coalesce("often", F.array().cast("array<string>"))))
    hosts = checkpointed(sizes.join(often, "host", "left").select("host", "n", F.array_compact(paths).alias("paths")))
    n_pages = hosts.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * HEAVY_HOSTS > n_pages
    heavy = hosts.where(is_heavy).select("host", F.col("paths").alias("heavy_paths"), F.lit("\x00").alias("spread"))
    light = hosts.where(~is_heavy).select(F.col("host").alias("key"), F.col("paths").alias("light_paths"))
    dealt = F.concat("spread", F.monotonically_increasing_id().cast("string"))  # no host's name
    joined = (
        pages.join(F.broadcast(heavy), "host", "left")
        .withColumn("key", F.coalesce(dealt, "host"))
        .join(light, "key", "left")
        .select("page_id", "url", F.coalesce("heavy_paths", "light_paths").alias("paths"), "html")
    )
    found = joined.mapInArrow(_extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
