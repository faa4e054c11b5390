"""Main text of web pages along paths that a host's pages agree on.

1. Every page is read once as a stream of tags and text. Containers score by the text right inside their blocks, less
   what stands in links; a page votes, with these scores, for its containers' generalised paths (tags and classes from
   the body down, digits as ``#``, ids left out).
2. Spark sums the votes per host and path. Votes are shares of a page, so long pages don't outvote others.
3. Every page is read again along its host's best paths that it has; a page that has none uses its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, comments of readers, scripts and styles never count, by
tag, role, or a word of class or id. Blocks are what block-level tags and line breaks part; white space in a block
becomes one space, blocks are joined by a line end. Where that leaves nothing at all, as on a page that stands in one
form or in a container of class ``right-sidebar``, the marked element with most text is taken for layout.

Null and empty pages give an empty text; a page without a host votes with the pages of no host. Repeated pages each give
a row. Time and memory grow with a page's length, however deep its tags are nested and whatever is left open.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from claimlens.llm.common import stored, table

#: A path wins on its host with this share of the votes; so there are at most a hundred winners per host.
WINNING_SHARE = 0.01

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
VOID = {*"area base br col embed hr img input link meta param source track wbr".split()}
#: Their content is no markup: it ends at their own end tag alone.
RAW = {*"script style noscript template textarea title iframe xmp noembed noframes".split()}
#: What stands in these is shown by other means or not at all. One that closes itself, or that nothing ends, holds nothing.
EMBEDDED = {*"svg math object audio video canvas".split()}
DROPPED = RAW | EMBEDDED | {*"head nav header footer aside form button select option dialog menu fieldset label datalist map".split()}
BLOCK = {*"address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()}
CONTAINER = {*"article body center div main section table tbody td tr blockquote".split()}
LISTS = {"ul", "ol", "dl"}
#: Longer paths are told apart by a digest.
PATH_LETTERS = 400
#: A container with less than this share of what its parent holds isn't all of an article by itself.
MOST = 0.75
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in a class, an id or a role that mark what is no part of an article.
ASIDE = re.compile(
    r"(?:\A|[\s_-])(?<!has-)(?<!with-)(?<!no-)(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed|s)?|promo(?:tion)?s?|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|bottombar|sidebar|side|"
    r"aside|complementary|contentinfo|cookies?|consent|notices?|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|form|search|share|sharing|social|related|recommended|"
    r"recommendations|comments?|commentlist|replies|reply|respond|discussion|disqus|widget|toolbar|skip|hidden|pagination|pager|tags|tagcloud|toc)(?=\Z|[\s_-])",
    re.I,
)
#: An open tag that such a start tag closes: a paragraph, and items of the same kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


class Reader:
    """Reads one page. Gives its blocks, each with the innermost container that holds it, and the letters in links.

    Containers are numbered as they are opened, 0 being the page; ``above`` holds the number of each one's parent.
    ``layout`` numbers start tags that are no part to leave out, whatever marks them.
    """

    def __init__(self, source: str, layout: frozenset[int] = frozenset()):
        self.blocks: list[tuple[int, str, int]] = []
        self.paths: list[str] = [""]
        self.above: list[int] = [0]
        self.open: list[tuple[str, int, bool]] = []
        self.holders: list[int] = [0]
        self.places: dict[str, list[int]] = {}  # of each name, where it is open
        self.stops: list[int] = []  # where open containers, lists and left-out elements are
        self.layout, self.tags = layout, 0
        self.marked: dict[int, int] = {}  # letters left out by the outermost element with a mark, by its start tag
        self.leaving: int | None = None
        self.dropped = self.links = self.linked = 0
        self.text: list[str] = []
        unended: set[str] = set()
        at, n = 0, len(source)
        while at < n:
            tag = TOKEN.search(source, at)
            self.say(source[at : tag.start() if tag else n])
            if not tag:
                break
            at = tag.end()
            if tag[2]:
                name = tag[2].lower()
                if tag[1]:
                    self.end(name)
                elif name in RAW or name in EMBEDDED:
                    self.cut(name)
                    alone = name in EMBEDDED and (tag[3].rstrip().endswith("/") or name in unended)
                    end = None if alone else re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    if end:
                        at = end.end()
                    elif name in RAW:
                        at = n
                    elif not alone:
                        unended.add(name)
                else:
                    self.start(name, tag[3])
        self.flush()

    def say(self, text: str) -> None:
        if text and not self.dropped:
            self.text.append(text)
            self.linked += len(text.strip()) * bool(self.links)
        elif text and self.leaving is not None and not self.links:
            self.marked[self.leaving] += len(text.strip())

    def flush(self) -> None:
        if self.text:
            said = SPACE.sub(" ", html.unescape("".join(self.text))).strip()
            if said:
                self.blocks.append((self.holders[-1], said, self.linked))
            self.text = []
        self.linked = 0

    def cut(self, name: str) -> None:
        if name in BLOCK:
            self.flush()

    def start(self, name: str, source: str) -> None:
        if name in VOID:
            self.cut(name)
            return
        if self.open and self.open[-1][0] == "head":
            self.pop()  # what can't stand in the head ends it
        if name in BLOCK or name in DROPPED:
            self.flush()
            self.close_implied(name)
        self.tags += 1
        found = attributes(source) if "=" in source or "hidden" in source else {}
        marks = " ".join((found.get("class", ""), found.get("id", ""), found.get("role", "")))
        unseen = "hidden" in found or found.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", "")))
        marked = name == "form" or (name not in ("html", "body", "article", "main") and name not in HEADING and bool(ASIDE.search(marks)))
        aside = unseen or (name in DROPPED and name != "form") or (marked and self.tags not in self.layout)
        if aside and not self.dropped and marked and not unseen and (name == "form" or name not in DROPPED):
            self.leaving = self.tags
            self.marked[self.tags] = 0
        held = name in CONTAINER and not self.dropped and not aside
        if held:
            classes = ".".join(sorted({DIGITS.sub("#", c) for c in found.get("class", "").split()}))
            path = f"{self.paths[self.holders[-1]]}/{name}{'.' if classes else ''}{classes}"
            if len(path) > PATH_LETTERS:
                path = f"#{xxhash.xxh3_128_hexdigest(path)}/{name}"
            self.above.append(self.holders[-1])
            self.paths.append(path)
            self.holders.append(len(self.paths) - 1)
        kind = 1 if held else 2 if aside else 0
        place = len(self.open)
        self.open.append((name, kind, name == "a"))
        self.places.setdefault(name, []).append(place)
        if kind or name in CONTAINER or name in LISTS:
            self.stops.append(place)
        self.dropped += aside
        self.links += name == "a"

    def pop(self) -> None:
        name, kind, link = self.open.pop()
        self.places[name].pop()
        if self.stops and self.stops[-1] == len(self.open):
            self.stops.pop()
        if kind == 1:
            self.holders.pop()
        self.dropped -= kind == 2
        if not self.dropped:
            self.leaving = None
        self.links -= link

    def close(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def close_implied(self, name: str) -> None:
        closed = CLOSES.get(name, set()) | ({"p"} if name not in ("td", "th", "tr") else set())
        while (place := max((p[-1] for c in closed if (p := self.places.get(c))), default=-1)) >= 0:
            if self.stops and self.stops[-1] > place:
                return
            self.close(place)

    def end(self, name: str) -> None:
        if name in BLOCK or name in DROPPED:
            self.flush()
        places = self.places.get(name)
        if not places:
            return
        # An inline or paragraph end tag reaches no further than its container.
        stop = next((s for s in reversed(self.stops) if self.open[s][1] or self.open[s][0] in CONTAINER), -1)
        if name in CONTAINER or name in DROPPED or stop <= places[-1]:
            self.close(places[-1])

    def scores(self) -> dict[str, float]:
        """Each container path's share of the page: its blocks' text without links, and half of what its children score.

        Children that hold an article in several pieces, none of them with most of the text, count in full.
        """
        own = [0.0] * len(self.paths)
        for holder, said, linked in self.blocks:
            own[holder] += max(0.0, len(said) - 2.0 * linked)
        whole, largest, below = list(own), [0.0] * len(own), [0.0] * len(own)
        for k in range(len(own) - 1, 0, -1):  # children come after their parents
            above = self.above[k]
            whole[above] += whole[k]
            largest[above] = max(largest[above], whole[k])
        out: dict[str, float] = {}
        for k in range(len(own) - 1, 0, -1):
            score = own[k] + below[k] * (0.5 if largest[k] >= MOST * whole[k] else 1.0)
            below[self.above[k]] += score
            if score:
                name = self.paths[k].rpartition("/")[2].partition(".")[0]
                out[self.paths[k]] = out.get(self.paths[k], 0.0) + score * (2.5 if name in ("article", "main") else 1.0)
        total = sum(out.values())
        return {p: s / total for p, s in out.items()} if total else {}

    def text_of(self, path: str | None) -> str:
        """All blocks in containers of that path; in the whole page without one."""
        inside = [path is None]
        for above, own in zip(self.above[1:], self.paths[1:]):
            inside.append(inside[above] or own == path)
        return "\n".join(said for holder, said, _ in self.blocks if inside[holder])

    def best(self, paths: list[str]) -> str | None:
        """The first of the paths that holds text here, else this page's own best."""
        filled = [False] * len(self.paths)
        for holder, *_ in self.blocks:
            filled[holder] = True
        for k in range(len(filled) - 1, 0, -1):
            filled[self.above[k]] |= filled[k]
        here = {path for path, held in zip(self.paths, filled) if held and path}
        found = next((p for p in paths if p in here), None)
        own = self.scores()
        return found or max(sorted(own), key=own.get, default=None)


def read_page(source: str) -> Reader:
    """The page as read; where nothing is left of it, with the marked element that holds most taken for layout, and so on."""
    layout: frozenset[int] = frozenset()
    while True:
        page = Reader(source, layout)
        most = max(page.marked.values(), default=0)
        if page.blocks or not most:
            return page
        layout |= {min(k for k, n in page.marked.items() if n == most)}


def host_of(url: Column) -> Column:
    """The url's host in lower case, without port; empty for none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Per host and path, the sum of its pages' scores and the number of pages that have it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], list[float]] = {}
            for host, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for path, score in read_page(value.as_py() or "").scores().items():
                    kept = sums.setdefault((host, path), [0.0, 0])
                    kept[0] += score
                    kept[1] += 1
            yield pa.RecordBatch.from_pydict({
                "host": pa.array([h for h, _ in sums], pa.string()), "path": pa.array([p for _, p in sums], pa.string()),
                "score": pa.array([s for s, _ in sums.values()], pa.float64()), "n": pa.array([n for _, n in sums.values()], pa.int64()),
            })

    read = pages.select(host_of(F.col(url)).alias("host"), F.col(source).cast("string").alias("html"))
    # Rounded, so that the order of summing changes no rank.
    return read.mapInArrow(run, "host string, path string, score double, n long").groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"), F.sum("n").alias("n"))


def consensus(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Each host's winning paths, best first: those with at least ``WINNING_SHARE`` of its votes."""
    counted = stored(votes(pages, url, source), "votes")
    totals = counted.groupBy("host").agg(F.sum("score").alias("total"))
    won = counted.join(totals, "host").where(F.col("score") >= WINNING_SHARE * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("rank"), "path")))
    return won.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, url: str = "url", source: str = "html", into: str = "text") -> DataFrame:
    """pages with the main text of each."""
    won = stored(consensus(pages, url, source).select(F.col("host").alias("__host"), F.col("paths").alias("__paths")), "consensus")

    @F.arrow_udf(StringType())
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sources, paths in batches:
            texts = []
            for value, own in zip(sources, paths):
                reader = read_page(value.as_py() or "")
                texts.append(reader.text_of(reader.best(own.as_py() or [])))
            yield pa.array(texts, pa.string())

    met = pages.join(won, host_of(F.col(url)) == F.col("__host"), "left")
    return met.withColumn(into, run.asNondeterministic()(F.col(source).cast("string"), F.col("__paths"))).drop("__host", "__paths")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text and its length in code points."""
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
