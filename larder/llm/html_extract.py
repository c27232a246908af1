"""Main text of web pages by equivalence-class template deduction.

Pages of one host are made from a template.  Its tokens (tags by their path, and whole text blocks
by path and content) occur equally often on every page, so all tokens of all blocks are grouped by
occurrence vector: Spark sums, for each token, hashes of (page, count) over the host's pages, and
equal sums are one class.  The class of the page itself (once on every page) is the root of the
template; classes with tags that occur on most pages nest inside it, so tags of valid classes are the
tree of the template and the text between them lies in its slots.  Each host's tree, with the text
that its slots hold on all pages, then gives the host's plan:

    container   The slot of the main text: from the root down, the part that stands once a page and
                holds most of the text that differs between pages, and most of all text without
                links.  It ends where another part holds a first heading or text of its own.
    template    Parts whose text is all template (in the root class, or with a tag in a nested one), unless
                most of the container's own text is (near copies, whose common text is theirs).
    records     Lists of reader comments and the like: tags of one class repeated on a page, with
                two or more texts and no heading each, that fill a part of their own beside a larger main text.

Everything outside the container, and template parts and records inside it, goes by class, whatever
its name.  What HTML calls its elements and usual names of page parts decide only between slots that
classes leave open: inside the container, and on hosts with too few pages, with equal pages only, or
where no part holds most of the text.  Neither classes nor names drop text of an article or main
element itself; text there that all pages share goes only with a part that holds nothing else.

Vectors are sums, so a host with a third of all pages is combined before the shuffle like any other
and no task ever holds a host.  A plan is bounded by the paths that half of a host's pages have.

Defined results
    NULL or empty html, or no main text: empty text, 0 characters.  NULL url: the pages of the
    empty host.  NULL page_id: kept.  Repeated rows: each is answered; they count as pages.  Pages
    without any token do not count as pages of their host.  A page of template text only (a host of
    equal pages) keeps its text, and pages without the container of their host, or with an article
    elsewhere, go by names.  Names of parts that differ by a number only are one name.  Broken markup: unclosed elements end with their parent, a stray "<" is
    text.  Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import common as C

SCHEMA = "page_id long, url string, text string, n_chars long"

# What HTML calls its elements, and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math xmp".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody
td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCKS - frozenset("caption tbody td tfoot th thead tr option legend summary".split())
DROPPED = frozenset("head title nav header footer aside form menu dialog select button label".split())
MAIN = frozenset(("article", "main"))
#: Parts that hold other blocks, those that the main text may fill, those that repeat as records, and those that
#: can be template inside an article.
PARTS = frozenset("""article aside body center details dialog dir div dl fieldset figure footer form head header html main menu nav ol
section table tbody td tfoot th thead tr ul""".split())
FILLED = frozenset("article body center div form html main section table tbody td tr".split())
RECORDS = frozenset("article div section".split())
BOXES = frozenset("aside dialog div footer form header menu nav section".split())
DROPPED_NAMES = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent
cookie cookies copyright disclaimer disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice
notices pager pagination popup promo promoted recommended related replies reply search share sharing sidebar signup skip social sponsor
sponsored subscribe subscription toolbar topbar widget widgets""".split())
MAIN_NAMES = frozenset("article articlebody content entry main maincontent post postbody story storybody".split())

_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*)>")
_LOOSE = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)([^>]*)>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")


@dataclass(frozen=True)
class TemplateParams:
    #: Pages a host needs before text can count as template.
    least_pages: int = 5
    #: Share of a host's pages on which a structural class must occur to nest in the template.
    share: float = 0.5
    #: Share of a host's pages on which text that stands once on a page is template by itself.
    near: float = 0.9
    #: Share of linked characters above which a block outside any article is a menu.
    link_share: float = 0.5


@dataclass
class Block:
    path: str
    text: str
    linked: int
    dropped: bool
    main: bool
    #: Stands in an article or main element that only the name of a part around it would drop.
    named: bool = False
    #: Paths of the elements around it that their tag or name would drop.
    cuts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Plan:
    """What the classes of a host say: the container's path (empty: open), paths of parts that go, and
    template texts (where the container is open)."""
    container: str = ""
    parts: frozenset[str] = frozenset()
    texts: frozenset[int] = frozenset()


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2] or (url or "")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


def _names_of(attributes: str) -> set[str]:
    if "=" not in attributes:
        return set()
    out = set()
    for m in _NAMES.finditer(attributes):
        for word in re.split(r"\s+", re.sub(r"([a-z])([A-Z])", r"\1-\2", m[1] or m[2] or m[3] or "").lower()):
            out.update(_SPLIT.split(word))
            out.add(re.sub(r"[-_\d]", "", word))  # a part's number is not its name: post-17, post-18
    return out - {""}


def blocks(html: str) -> tuple[list[Block], Counter]:
    """(text blocks in page order, how often each tag path occurs)."""
    out: list[Block] = []
    paths: Counter = Counter()
    # an open element: (tag, path, dropped, in main, dropped by names only, article in such a part, dropping paths)
    stack: list[tuple[str, str, bool, bool, bool, bool, tuple[str, ...]]] = [("", "", False, False, False, False, ())]
    text: list[str] = []
    linked = [0, 0]  # open links, linked characters of this block

    def flush():
        said = " ".join("".join(text).split())
        if said:
            _, path, dropped, main, _, named, cuts = next(e for e in reversed(stack) if e[0] in BLOCKS or not e[0])
            out.append(Block(path, said, linked[1], dropped, main, named, cuts))
        text.clear()
        linked[1] = 0

    def close(depth: int):
        for tag, *_ in stack[depth:]:
            if tag in BLOCKS:
                flush()
                break
        linked[0] -= sum(e[0] == "a" for e in stack[depth:])
        del stack[depth:]

    def say(part: str):
        said = markup.unescape(part)
        text.append(said)
        if linked[0]:
            linked[1] += len(said.strip())

    at, n = 0, len(html)
    low = None
    while at < n:
        start = html.find("<", at)
        if start < 0:
            say(html[at:])
            break
        if start > at:
            say(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, start) or _LOOSE.match(html, start)
        if not m:
            say("<")
            at = start + 1
            continue
        at = m.end()
        tag = m[1].lower()
        if html[start + 1] == "/":
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            # an end tag never closes past the article or table cell it stands in
            if depth and not any(stack[i][0] in ("article", "main", "td", "body") for i in range(depth + 1, len(stack))) or tag in MAIN and depth:
                close(depth)
            elif tag == "br":
                text.append(" ")
            continue
        if tag in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in BLOCKS), 0)
            if depth and stack[depth][0] == "p":
                close(depth)
        if tag in ("li", "option", "tr", "td", "th", "dt", "dd") and any(e[0] == tag for e in stack):
            depth = max(i for i, e in enumerate(stack) if e[0] == tag)
            if not any(e[0] in ("ul", "ol", "table", "dl", "select") for e in stack[depth + 1:]):
                close(depth)
        _, above, dropped, main, by_name, named, cuts = stack[-1]
        names = _names_of(m[2])
        path = f"{above}/{tag}" + (f".{'.'.join(sorted(names))}" if names else "")
        if tag in BLOCKS:
            flush()
        paths[path] += 1
        if tag == "br":
            text.append(" ")
        if tag in VOID or m[2].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            if low is None:
                low = html.lower()
            end = low.find(f"</{tag}", at)
            after = html.find(">", end) if end >= 0 else -1
            at = n if after < 0 else after + 1
            continue
        own_header = tag == "header" and main  # an article's own heading stays
        by_tag = tag in DROPPED and not own_header
        listed = bool(names & DROPPED_NAMES) and tag not in ("body", "html", "main", "article") and not own_header
        # under a part dropped by its name an article is remembered; a listed part in it ends that
        named = not by_tag and not listed and (named or by_name and tag in MAIN)
        by_name = not by_tag and (by_name or listed and not dropped)
        dropped = dropped or by_tag or listed
        main = main or not dropped and (tag in MAIN or "main" in names and tag not in ("body", "html") or tag in ("div", "section") and bool(names & MAIN_NAMES))
        if tag == "a":
            linked[0] += 1
        stack.append((tag, path, dropped, main, by_name, named, (*cuts, path) if by_tag or listed else cuts))
    close(1)
    flush()
    return out, paths


def candidates(found: list[Block], params: TemplateParams) -> list[Block]:
    """Blocks of the slots that can be main text: those of the article or main element; where a
    page has none, those of the body that are not mostly links, and those of articles in parts
    that are dropped by name."""
    inside = [b for b in found if b.main and not b.dropped]
    return inside or [b for b in found if b.named or not b.dropped and b.linked <= params.link_share * len(b.text)]


def token(*parts: str) -> int:
    return C.digest("\x00".join(parts).encode("utf-8", "surrogatepass"))[0]


#: One token of a host: two independent sums of page hashes make its occurrence vector's name.
#: ``slot`` is a text's path, ``path`` a tag's; ``chars`` and ``plain`` are all and unlinked characters of a
#: text, or of all text in a tag, ``own`` the unlinked ones of blocks that stand in the tag itself.
TOKEN = """host string, token long, is_text boolean, slot long, path string, vector1 long, vector2 long, pages long, total long, chars long,
plain long, own long"""
_KINDS = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string()] + [pa.int64()] * 7


def above(path: str) -> str:
    return path.rpartition("/")[0]


def tag_of(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def page_tokens(html: str | None) -> dict[tuple[int, bool], tuple[int, int | None, str | None, int, int, int]]:
    """(token, is_text): (times, slot, path, chars, plain, own) of one page; empty if it has no token."""
    found, paths = blocks(html or "")
    chars, plain, own = Counter(), Counter(), Counter()
    out = {}
    for b in found:
        n, free = len(b.text), max(len(b.text) - b.linked, 0)
        chars[b.path] += n
        own[b.path] += free
        key = (token("text", b.path, b.text), True)
        times, *_, n0, free0, _ = out.get(key, (0, None, None, 0, 0, 0))
        out[key] = (times + 1, token("tag", b.path), None, n0 + n, free0 + free, 0)
    plain.update(own)
    for path in sorted(paths, key=len, reverse=True):  # a path is longer than the one around it
        chars[above(path)] += chars[path]
        plain[above(path)] += plain[path]
    for path, times in paths.items():
        out[(token("tag", path), False)] = (times, None, path, chars[path], plain[path], own[path])
    if out:
        out[(0, False)] = (1, None, "", chars[""], plain[""], own[""])
    return out


def occurrences(pages: DataFrame, params: TemplateParams) -> DataFrame:
    """``TOKEN`` rows: every token's vector and sums.  The token 0 is the page itself.  Tasks add up
    their own pages first."""

    def run(batches):
        sums: dict[tuple, list[int]] = defaultdict(lambda: [0] * 7)

        def emit():
            rows = [(*k, *v) for k, v in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], [c.split()[0] for c in TOKEN.split(",")])

        for batch in batches:
            for url, html, row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                host = host_of(url)
                counts = page_tokens(html)  # a page without tokens says nothing of its host's template
                # 40-bit terms, one pair for each count on this page
                terms = {n: [x & 0xFFFFFFFFFF for x in C.digest(f"{row}:{n}".encode())] for n in {v[0] for v in counts.values()}}
                for (key, is_text), (n, slot, path, *held) in counts.items():
                    sum_of = sums[(host, key, is_text, slot, path)]
                    for i, x in enumerate((*terms[n], 1, n, *held)):
                        sum_of[i] += x
                if len(sums) > 50_000:
                    yield emit()
        if sums:
            yield emit()

    # pages need a name of their own that a repeated task gives again: their content
    keyed = pages.select("url", "html", F.xxhash64("page_id", "url", "html").alias("row"))
    return (keyed.mapInArrow(run, TOKEN).groupBy("host", "token", "is_text")
            .agg(F.max("slot").alias("slot"), F.max("path").alias("path"),
                 *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("vector1", "vector2")],
                 *[F.sum(c).alias(c) for c in ("pages", "total", "chars", "plain", "own")]))


def template(tokens: DataFrame, params: TemplateParams) -> DataFrame:
    """(host, token, is_text, class, size, is_root, is_fixed, and the columns of ``occurrences``): the
    valid equivalence classes of each host; ``is_fixed`` marks text of the template.  Tags on ``share`` of the pages
    that are alone in their class come along: they lie between the tags of valid classes.

    Valid: the root class, classes of two or more tokens, a tag among them, on at least ``share`` of
    the host's pages, whose tokens stand between the root's, and text once a page on ``near`` of them."""
    root = tokens.where((F.col("token") == 0) & ~F.col("is_text")).select(
        "host", F.col("vector1").alias("root1"), F.col("vector2").alias("root2"), F.col("pages").alias("host_pages"))
    # tokens of one class are on the same pages, so rare ones can go before classes are counted
    often = tokens.where(F.col("pages") >= params.share * params.least_pages)  # most text stands on one page: it does not travel
    classed = (often.join(root, "host").where((F.col("host_pages") >= params.least_pages) & (F.col("pages") >= params.share * F.col("host_pages")))
               .withColumn("is_root", (F.col("vector1") == F.col("root1")) & (F.col("vector2") == F.col("root2"))))
    sizes = classed.groupBy("host", "vector1", "vector2").agg(F.count("*").alias("size"), F.max(~F.col("is_text")).alias("has_tag"))
    nearly = F.col("is_text") & (F.col("pages") >= params.near * F.col("host_pages")) & (F.col("total") == F.col("pages"))
    return (classed.join(sizes, ["host", "vector1", "vector2"])
            .where(~F.col("is_text") | F.col("is_root") | ((F.col("size") > 1) & F.col("has_tag")) | nearly)
            .select("host", "token", "is_text", F.xxhash64("vector1", "vector2").alias("class"), "size", "is_root", F.col("is_text").alias("is_fixed"),
                    "slot", "path", "pages", "total", "chars", "plain", "own"))


def plan_of(tags: list[dict], params: TemplateParams) -> Plan | None:
    """The plan of one host from its common tags, the page itself (path "") among them: path, class,
    pages, total, chars, plain, own, and fixed_chars, fixed_plain of the template texts that stand in the tag
    itself.  None: its pages do not differ."""
    at = {t["path"]: t for t in tags}
    fixed, fixed_plain, kids = Counter(), Counter(), defaultdict(list)
    for path in sorted(at, key=len, reverse=True):
        fixed[path] += at[path]["fixed_chars"]
        fixed_plain[path] += at[path]["fixed_plain"]
        if path:
            fixed[above(path)] += fixed[path]
            fixed_plain[above(path)] += fixed_plain[path]
            kids[above(path)].append(path)
    plain = {p: t["plain"] for p, t in at.items()}
    free = {p: plain[p] - fixed_plain[p] for p in at}
    own_free = {p: t["own"] - t["fixed_plain"] for p, t in at.items()}
    if free.get("", 0) <= 0:
        return None

    def inside(path: str):
        left = [path]
        while left:
            yield (path := left.pop())
            left += kids[path]

    def open_text(path: str) -> bool:
        """A part that main text may stand in, beside the one that holds most of it."""
        return free[path] > 0 and (tag_of(path) not in PARTS or any(tag_of(p) == "h1" and own_free[p] > 0 for p in inside(path)))

    here = ""
    while tag_of(here) not in MAIN and own_free[here] <= 0:
        once = [k for k in kids[here] if tag_of(k) in FILLED and at[k]["total"] == at[k]["pages"]]
        best = max(once, key=lambda k: (free[k], k), default=None)
        if best is None or 2 * free[best] <= free[here] or 2 * plain[best] <= plain[here] or any(open_text(k) for k in kids[here] if k != best):
            break
        here = best
    container = here if tag_of(here) not in ("", "html", "body") else ""

    def in_article(path: str) -> bool:
        return any(tag in MAIN for tag in (part.partition(".")[0] for part in path.split("/")))

    parts = set()
    records = defaultdict(list)
    for p in inside(here):  # a part comes before what is in it
        boxes = BOXES if in_article(here) else PARTS - MAIN
        if p != here and tag_of(p) in boxes and at[p]["chars"] > 0 and at[p]["chars"] == fixed[p] and not any(p.startswith(q + "/") for q in parts):
            parts.add(p)
        if at[p]["total"] > at[p]["pages"]:
            records[at[p]["class"]].append(p)
    rest = at[here]["chars"] - sum(at[p]["chars"] for p in parts)
    if 2 * (fixed[here] - sum(fixed[p] for p in parts)) > rest:
        parts.clear()  # near copies: most of what the pages share is their own text
    for same in records.values():
        top = min(same, key=len)
        group = above(top)
        if (tag_of(top) in RECORDS and not in_article(group) and len(group) > len(here) and all(p == top or p.startswith(top + "/") for p in same)
                and sum(own_free[p] > 0 for p in same) > 1 and not any(re.fullmatch("h[1-6]", tag_of(p)) for p in same)
                and free[group] == free[top] and 2 * free[group] < free[here]):
            parts.add(group)
    return Plan(container, frozenset(parts))


#: The plan of a host as a row.
PLAN = "host string, container string, parts array<string>, texts array<long>"


def plans(found: DataFrame, params: TemplateParams) -> DataFrame:
    """``PLAN`` rows, one for each host whose pages differ, from the classes of ``template``."""
    texts = (found.where("is_fixed").groupBy("host", F.col("slot").alias("token"))
             .agg(F.sum("chars").alias("fixed_chars"), F.sum("plain").alias("fixed_plain"), F.collect_set("token").alias("texts")))
    # text in the page itself has the slot of the empty path; the page's own token is 0
    texts = texts.withColumn("token", F.when(F.col("token") == token("tag", ""), F.lit(0)).otherwise(F.col("token")))
    columns = ["path", "class", "pages", "total", "chars", "plain", "own", "fixed_chars", "fixed_plain"]
    tags = (found.where(~F.col("is_text")).join(texts, ["host", "token"], "left").fillna(0, ["fixed_chars", "fixed_plain"])
            .groupBy("host").agg(F.collect_list(F.struct(*columns)).alias("tags"), F.flatten(F.collect_list("texts")).alias("texts")))

    def run(batches):
        for batch in batches:
            rows = []
            for host, common, texts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                plan = plan_of(common, params)
                if plan:
                    rows.append((host, plan.container, sorted(plan.parts), [] if plan.container else texts))
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "container", "parts", "texts"])

    return tags.select("host", "tags", "texts").mapInArrow(run, PLAN)


def page_text(html: str | None, plan: Plan | None, params: TemplateParams) -> str:
    """Main text of one page, given its host's plan."""
    found = blocks(html or "")[0]
    kept = candidates(found, params)
    if plan is None:
        return "\n".join(b.text for b in kept)
    within, inside = plan.container + "/", plan.container != ""
    if inside:
        part = [b for b in found if (b.path + "/").startswith(within)]
        if not part or any(b.main and not b.dropped and not (b.path + "/").startswith(within) for b in found):
            inside = False  # a page of another make
        else:
            # names around the container say nothing, those inside it decide what classes leave open
            open_parts = [Block(b.path, b.text, b.linked, any(len(c) > len(plan.container) for c in b.cuts), b.main, b.named) for b in part]
            kept = candidates(open_parts, params) or part
    if plan.parts:
        cut = [p + "/" for p in plan.parts]
        free = [b for b in kept if not any((b.path + "/").startswith(c) for c in cut)]
        kept = free or kept
    if plan.texts and not inside:
        free = [b for b in kept if b.main or token("text", b.path, b.text) not in plan.texts]
        # near copies have most of their text in common, which is theirs and no template
        kept = free if 2 * sum(len(b.text) for b in free) >= sum(len(b.text) for b in kept) else kept
    return "\n".join(b.text for b in kept)


#: Plans of at most this many bytes are sent to every task; more are joined by host and salt.
SENT_BYTES = 32 << 20
SALTS = 32


def main_text(pages: DataFrame, params: TemplateParams = TemplateParams(), sent_bytes: int = SENT_BYTES) -> DataFrame:
    """page_id, url, text, n_chars of every page of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    scratch = C.Scratch(pages.sparkSession, "html")
    tokens = scratch.keep(occurrences(pages, params), "tokens")  # read twice
    found = scratch.keep(template(tokens, params), "template")  # what half of a host's pages have in common, read twice
    scratch.drop("tokens")
    made = scratch.keep(plans(found, params), "plans")
    scratch.drop("template")
    strings = F.coalesce(F.aggregate("parts", F.lit(0), lambda n, p: n + F.octet_length(p) + 8), F.lit(0))
    size = made.agg(F.sum(F.octet_length("host") + F.octet_length("container") + strings + 8 * F.size("texts") + 64).alias("n")).first()["n"] or 0

    def split(batches):
        for batch in batches:
            ids, urls, texts = (batch.column(i) for i in range(3))
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array([host_of(u) for u in urls.to_pylist()], pa.string()), texts], ["page_id", "url", "host", "html"])

    def run(batches):
        for batch in batches:
            texts = []
            for html, container, parts, common in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                plan = None if container is None else Plan(container, frozenset(parts), frozenset(common))
                texts.append(page_text(html, plan, params))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    hosted = pages.mapInArrow(split, "page_id long, url string, host string, html string")
    if size <= sent_bytes:
        both = hosted.join(F.broadcast(made), "host", "left")
    else:  # a host with a third of all pages is dealt over all salts
        salt = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS))
        salted = made.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        both = hosted.withColumn("salt", salt.cast("long")).join(salted, ["host", "salt"], "left")
    return both.select("page_id", "url", "html", "container", "parts", "texts").mapInArrow(run, SCHEMA)
