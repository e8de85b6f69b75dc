"""Main text of web pages by consensus of a host's pages.

Every page votes for one container, the deepest that holds nearly all of its prose; containers are known by their path
of tags and generalised classes. Spark adds up the votes of each host. A layout that recurs on its host keeps its own
container, however rare it is, and what its neighbours take for text; a page whose layout is like no other's is read
as its neighbours are.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import annotated, argument, map_frames, written

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*+)([^>]*+)(?:>|\Z)""", re.S
)
#: What is not prose whatever it holds; the first three end only at their own end tag.
RAW = ("script", "style", "textarea")
NEVER = frozenset((*RAW, "title"))
#: What stands beside the text unless it holds most of the page's prose.
ASIDE = frozenset("head nav header footer aside form noscript template iframe select button svg object menu dialog".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
UNNAMED = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption tr td th tbody thead tfoot hr html".split())
ARTICLE = ("article", "main")
ROOT = 0
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SIDE_PART = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|captcha|comments?|consent|cookies?|disclaimer|disqus|footer|gdpr|header|login|masthead|menu"
    r"|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|related|replies|respond|search|share|sharing|sidebar|signup|social"
    r"|sponsor\w*|subscribe|tags|teaser|toolbar|widget"
)
#: Before the name of a side part, these say what an element has, lacks or is about; after it, in what state something else is.
MODIFIERS = frozenset("has no not non with without is in under hide show category cat tag tagged topic type format status".split())
STATES = frozenset("open opened closed on off enabled disabled allowed active visible hidden collapsed expanded true false".split())
#: A side part counts as the whole name or beside words that say no more than where it stands or what it is made of.
COMPANIONS = frozenset(
    "area article articles bar block blocks bottom box button buttons col column container content count desktop entry form global group icon icons"
    " inline inner item items left level link links list main mobile news outer page panel post posts primary right row secondary section sections"
    " site slot stories story text the top unit widget widgets wrap wrapper".split()
)
#: These say by themselves that they are text, whatever their name.
SPOKEN = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Readers' own words can be longer than the text they are about.
REPLIES = re.compile(r"comments?|disqus|replies|respond")


#: Parts of class names that style generators make of hashes: letters after digits, or no vowel; and what they put before.
MADE = re.compile(r"(?=\w{4})\w*\d[a-z]\w*|[b-df-hj-np-tv-xz]{5,}")
MAKERS = frozenset("css sc jss jsx emotion svelte makestyles".split())


def side_parts(value: str) -> list[str]:
    """The parts of class, id or role tokens by which an element stands beside the text: sidebar, site-header, ad-box.

    Tokens that tell what a wrapper has, lacks or is about (has-sidebar, no-comments, category-social, menu-open) do not
    count, nor do those where another word makes it a subject (share-price, search-history).
    """
    named = []
    for token in value.lower().split():
        parts = re.split(r"[-_]+", token)
        if parts[-1] in STATES:
            continue
        found, alone = [], True
        for part in parts:
            if part in MODIFIERS:
                break
            if SIDE_PART.fullmatch(part):
                found.append(part)
            elif part not in COMPANIONS and not part.isdigit() and not MADE.fullmatch(part):
                alone = False
        named += found if alone else []
    return named


def general(token: str) -> str:
    """A class without what differs from page to page: numbers, and all from the first part made by a style generator."""
    kept = []
    for part in re.split(r"[-_]+", token):
        if MADE.fullmatch(part) or kept and kept[-1] in MAKERS:
            break
        kept.append(re.sub(r"\d+", "", part))
    return "" if kept and kept[-1] in MAKERS else "-".join(kept)


def names(attributes: str) -> tuple[str, list[str]]:
    """The generalised class of an element, and what in its class, id or role names something beside the text."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in NAMED.finditer(attributes)}
    first = (found.get("class", "").lower().split() or [""])[0]
    return general(first), [part for v in found.values() for part in side_parts(v)]


def blocks(page: str, tree: dict[int, tuple[int, str]] | None = None) -> list[tuple[int, str, int]]:
    """(container, text, characters inside links) of each block of prose, in page order.

    A container is a 64-bit hash of its path; ``tree`` is given the parent and the tag of each, parents first. Elements left
    open end with the page or with what must close them, an open nav or header also with an article or main; broken markup
    at the end of a page is no text. Elements beside the text are left out as :func:`dropped` says.
    """
    out: list[tuple[int, str, int, int]] = []
    open_: list[tuple[str, int, int]] = []  # tag, container, number of the innermost element beside the text or 0
    sides: list[tuple[int, str]] = [(0, "")]  # the element beside the text around each, and its kind
    in_article: set[int] = set()
    tree = {} if tree is None else tree
    pieces: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            out.append((*(open_[-1][1:] if open_ else (ROOT, 0)), text, linked))
        pieces.clear()
        linked = 0

    def text_until(end: int) -> None:
        nonlocal linked
        if end > at and not (open_ and sides[open_[-1][2]][1] == "never"):
            pieces.append(page[at:end])
            linked += (end - at) * bool(in_link)

    while m := MARKUP.search(page, at):
        text_until(m.start())
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if tag == "a":
            in_link = 0 if closing else 1
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            continue
        flush()
        if closing:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), None)
            if depth is not None:
                in_link = 0
                del open_[depth:]
        elif tag not in EMPTY:
            if open_ and open_[-1][0] in CLOSED_BY_BLOCK:
                open_.pop()
            if tag == "li" and open_ and open_[-1][0] == "li":
                open_.pop()
            if tag in ARTICLE:
                depth = next((i for i, o in enumerate(open_) if o[0] in ("nav", "header")), len(open_))
                in_link *= depth == len(open_)
                del open_[depth:]
            name, parts = names(attributes)
            inside, side = open_[-1][1:] if open_ else (ROOT, 0)
            if tag not in UNNAMED:
                parent, inside = inside, xxhash.xxh64_intdigest(f"{inside}>{tag}.{name}") - (1 << 63)
                tree.setdefault(inside, (parent, tag))
                if tag in ARTICLE or parent in in_article:
                    in_article.add(inside)
            if not attributes.rstrip().endswith("/"):
                if tag in NEVER or tag in ASIDE or parts and tag not in ("html", "body", *ARTICLE) and tag not in SPOKEN:
                    replies = parts and all(map(REPLIES.fullmatch, parts)) and tag not in ASIDE
                    sides.append((side, "never" if tag in NEVER else "replies" if replies else "side" if tag in ASIDE else "named"))
                    side = len(sides) - 1
                open_.append((tag, inside, side))
            if tag in RAW:
                end = re.compile(rf"</{tag}\b", re.I).search(page, at)
                at = end.start() if end else len(page)
    text_until(len(page))
    flush()
    gone = dropped([(side, prose(text, n), c in in_article) for c, side, text, n in out], sides)
    return [(c, text, n) for c, side, text, n in out if not gone[side]]


def dropped(spoken: list[tuple[int, float, bool]], sides: list[tuple[int, str]]) -> list[bool]:
    """Of each element beside the text, whether it is left out, from (element, prose, in an article or main) of all blocks.

    Those that hold most of the page's prose stay, as wrappers or as elements that were never closed; readers' comments stay
    only if nothing else holds prose. On a page whose article or main holds prose outside such elements, only those stay that
    lie inside it, hold most of the prose and stand beside the text by name alone.
    """
    settled = any(p and article and not side for side, p, article in spoken)
    held, within = [0.0] * len(sides), [False] * len(sides)
    for side, p, article in spoken:
        held[side] += p
        within[side] |= bool(p and article)
    for i in range(len(sides) - 1, 0, -1):
        held[sides[i][0]] += held[i]
        within[sides[i][0]] |= within[i]
    gone = [False]
    for i, (outer, kind) in enumerate(sides[1:], 1):
        most = 2 * held[i] > held[0]
        if settled:
            spared = kind == "named" and most and within[i]
        else:
            spared = kind in ("side", "named") and most or kind == "replies" and 0 < held[0] == held[i]
        gone.append(gone[outer] or not spared)
    return gone


def prose(text: str, linked: int) -> float:
    """How much a block speaks for its container: its length, less what is links, more for the marks of sentences."""
    return max(0.0, len(text) - 3.0 * linked) * (1 + min(1.0, sum(map(text.count, ",.;:!?")) / 10))


def outwards(container: int, tree: dict[int, tuple[int, str]]) -> list[int]:
    """A container and those around it, to the root."""
    chain = [container]
    while chain[-1] != ROOT:
        chain.append(tree[chain[-1]][0])
    return chain


def ballot(page: str | None, whole: float) -> tuple[list[int], list[int]]:
    """The container a page votes for, in a list, and all containers that hold text of it.

    It is the deepest that holds ``whole`` of the prose, or the article or main element around that. Text right beside it
    in a container other than the body, like a heading or a lead, belongs to it, so then the container around both is
    taken. A page without prose has no vote.
    """
    tree: dict[int, tuple[int, str]] = {}
    found = blocks(page or "", tree)
    direct = {c for c, _, _ in found}
    held = dict.fromkeys([ROOT, *tree], 0.0)
    for container, text, linked in found:
        held[container] += prose(text, linked)
    some = set(direct)
    for container in reversed(tree):
        held[tree[container][0]] += held[container]
        if container in some:
            some.add(tree[container][0])
    if not held[ROOT]:
        return [], sorted(some)
    within = {tree[c][0]: c for c in tree if held[c] >= whole * held[ROOT]}
    best = ROOT
    while best in within:
        best = within[best]
    chain = outwards(best, tree)
    last = 0
    for i, container in enumerate(chain):
        tag = tree[container][1] if container != ROOT else ""
        if tag in ARTICLE or (i and container in direct and tag not in ("", "body")):
            last = i
    return [chain[last]], sorted(some)


def extract(page: str | None, chosen: list[int] | None, whole: float = 0.98) -> str:
    """The blocks inside the chosen containers; without any, those of the container the page itself votes for.

    Text that lies in the body itself beside a container, like a headline, a lead or a closing paragraph, belongs to it,
    unless the container is an article or main element, which tell where they begin and end.
    """
    tree: dict[int, tuple[int, str]] = {}
    found = blocks(page or "", tree)
    chosen = chosen or ballot(page, whole)[0][:1]
    inside = {ROOT: ROOT in chosen}
    for container, (parent, _) in tree.items():
        inside[container] = container in chosen or inside[parent]
    beside: set[int] = set()
    for container in set(chosen) & tree.keys():
        around = outwards(container, tree)
        if not any(c != ROOT and tree[c][1] in ARTICLE for c in around):
            beside.update(c for c in around if c == ROOT or tree[c][1] == "body")
    return "\n\n".join(text for container, text, linked in found if inside[container] or container in beside and prose(text, linked))


def main_text(pages: DataFrame, share: float = 0.25, whole: float = 0.98, backing: int = 2) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    A page votes for the deepest container that holds ``whole`` of its prose (see :func:`ballot`). Containers with at least
    ``backing`` votes of their host are those of its templates. A page is read along all of them that hold text of it and
    have ``share`` of the votes of the page's own, so a rare template is judged by its own pages and not by the host's size.
    If nobody shares a page's vote, ``share`` is of the votes of the best container that holds text of it, and if there
    is none the page is read along its own. All blocks inside are kept but those beside the text.

    Null or empty html gives an empty text; a null or odd url belongs to the host ''. Repeated rows give repeated rows, and
    vote as often. Other columns are ignored. Pages with the same vote and containers are one layout, counted before and
    after the shuffle; layouts meet the votes in equi joins on (host, container), pages meet their layout's choice in one on
    (host, hash of html), so no list is longer than the containers of one page.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    named = argument(pages, "page_id", "url", "html").withColumn("host", host).withColumn("mark", F.xxhash64("html", F.length("html")))

    def ballots(frame: pd.DataFrame) -> pd.DataFrame:
        cast = [ballot(page, whole) for page in frame["html"]]
        layouts = [xxhash.xxh64_intdigest(repr(c)) - (1 << 63) for c in cast]
        return pd.DataFrame({"host": frame["host"], "mark": frame["mark"], "layout": layouts, "vote": [c[0] for c in cast], "holding": [c[1] for c in cast]})

    seen = map_frames(named.select("host", "mark", "html"), ballots, "host string, mark long, layout long, vote array<long>, holding array<long>")
    seen = written(seen, "ballots")
    layouts = seen.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("pages"), F.first("vote").alias("vote"), F.first("holding").alias("holding"))
    layouts = written(layouts, "layouts")
    votes = layouts.where(F.size("vote") > 0).groupBy("host", F.get("vote", F.lit(0)).alias("container")).agg(F.sum("pages").alias("votes"))
    votes = written(votes.where(F.col("votes") >= backing), "votes")

    met = layouts.select("host", "layout", F.get("vote", F.lit(0)).alias("own"), F.explode("holding").alias("container")).join(votes, ["host", "container"])
    least = share * F.coalesce(F.max(F.when(F.col("container") == F.col("own"), F.col("votes"))), F.max("votes"))
    met = met.groupBy("host", "layout").agg(least.alias("least"), F.collect_list(F.struct("container", "votes")).alias("met"))
    chosen = met.select("host", "layout", F.expr("transform(filter(met, m -> m.votes >= least), m -> m.container)").alias("chosen"))
    by_page = written(seen.groupBy("host", "mark").agg(F.first("layout").alias("layout")).join(chosen, ["host", "layout"]).select("host", "mark", "chosen"), "chosen")

    def extracted(pages: list[str | None], choices: list[list[int] | None]) -> list[list]:
        texts = [extract(p, c, whole) for p, c in zip(pages, choices, strict=True)]
        return [texts, [len(t) for t in texts]]

    joined = named.join(by_page, ["host", "mark"], "left").select("page_id", "url", "html", "chosen")
    out = annotated(joined, ["html", "chosen"], extracted, "text string, n_chars long", keep=["page_id", "url"])
    return out.select("page_id", "url", "text", "n_chars")
