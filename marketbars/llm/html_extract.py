"""Main text of pages by equivalence classes of template tokens.

Tokens are elements, told apart by the elements that hold them, and text runs in
their place. A token's occurrence vector says how often it occurs in each page
of a host; grouped sums of page hashes stand for the vector, so no host is ever
gathered. Tokens of one host with equal vectors form an equivalence class. A
class is valid if it is frequent, large enough, and its tokens come in the same
order in every page. Valid classes nest by the elements that hold them into the
host's template. Text runs that are themselves template tokens are fixed; all
other text varies, and an element's share of it tells what the element holds.
The article's slot is the lowest element that occurs once a page and holds all
varying text but what surrounds the article. Elements that are named article or
main narrow it if they hold half of that text. The text of a page is all that is
in the slots, fixed runs included; nothing is left out by its frequency there.

Pages are parsed three times. Templates are broadcast while they are few;
beyond that pages and templates are joined by host.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm.common import kept
from marketbars.llm.html_pages import TEXT_BLOCKS, Element, Run, read

SUPPORT = 0.5  # share of a host's pages that a template token occurs in
LEAST_TOKENS = 2  # of a class
TEXT_SUPPORT = 0.9  # the same of a fixed text
NAMED_SHARE = 0.5  # of the varying text, in elements named article or main that are to be the slots
PRIME = (1 << 31) - 1  # occurrence vectors are summed modulo this, so that no host overflows
HELD_TOKENS = 200_000  # counts that a task gathers before it passes them on
BROADCAST_TOKENS = 1_000_000  # template tokens of all hosts, 16 bytes each

HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)")


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found.group(1).lower() if found else ""


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >= 1 << 63 else value


def run_token(run: Run) -> int:
    return _hash(f"{run.holder.role} {run.text}")


def _rows(batch: pa.RecordBatch):
    return zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)))


TOKENS = (
    "host string, token long, pages long, total long, v1 long, v2 long, "
    "text boolean, depth long, main boolean, aside boolean, block boolean"
)
NAMES = [part.split()[0] for part in TOKENS.split(", ")]
KINDS = [pa.string(), *[pa.int64()] * 5, pa.bool_(), pa.int64(), *[pa.bool_()] * 3]


def _token_counts(batches):
    """Per host and token what its vector sums up to, and what kind of token it is."""
    seen: dict[tuple[str, int], list] = {}

    def out():
        columns = zip(*((*key, *value) for key, value in seen.items())) if seen else [[]] * 11
        return pa.record_batch(
            [pa.array(list(c), k) for c, k in zip(columns, KINDS)], NAMES
        )

    for batch in batches:
        for page_id, url, page in _rows(batch):
            host = host_of(url)
            counts: dict[int, list] = {}  # token -> count, text, depth, main, aside, block
            for event in read(page):
                if isinstance(event, Element):
                    token = event.role
                    about = [0, False, len(event.parents), event.main, event.aside,
                             event.tag in TEXT_BLOCKS]
                else:
                    token = run_token(event)
                    about = [0, True, len(event.holder.parents), False, event.holder.aside, True]
                counts.setdefault(token, about)[0] += 1
            h = xxhash.xxh64_intdigest(f"{page_id} {url}")
            counts[0] = [1, False, 0, False, False, False]  # the page itself
            for token, (n, *about) in counts.items():
                entry = seen.setdefault((host, token), [0, 0, 0, 0, *about])
                entry[0] += 1
                entry[1] += n
                entry[2] = (entry[2] + n * (h & 0x7FFFFFFF)) % PRIME
                entry[3] = (entry[3] + n * (h >> 33)) % PRIME
            if len(seen) > HELD_TOKENS:
                yield out()
                seen.clear()
    yield out()


def _near(templates: DataFrame, tokens: int) -> DataFrame:
    return F.broadcast(templates) if tokens <= BROADCAST_TOKENS else templates


def classes(pages: DataFrame) -> DataFrame:
    """Frequent tokens with the class they belong to, of classes large enough."""
    tokens = kept(
        pages.mapInArrow(_token_counts, TOKENS)
        .groupBy("host", "token")
        .agg(
            *(F.sum(c).alias(c) for c in ("pages", "total")),
            *(F.pmod(F.sum(c), F.lit(PRIME)).alias(c) for c in ("v1", "v2")),
            F.min("depth").alias("depth"),
            *(F.bool_or(c).alias(c) for c in ("text", "main", "aside", "block")),
        )
        .where(~F.col("text") | (F.col("pages") > 1))
    )
    hosts = tokens.where("token = 0").select(F.col("host").alias("_host"), F.col("pages").alias("n"))
    # Pages that are all alike do not tell what is fixed.
    content = F.xxhash64("html")
    differing = pages.groupBy(host_column(F.col("url")).alias("_text_host")).agg(
        (F.min(content) < F.max(content)).alias("differ")
    )
    frequent = (
        tokens.where("token <> 0")
        .join(hosts, F.col("host") == F.col("_host"))
        .join(differing, F.col("host") == F.col("_text_host"))
        .where(
            F.when(
                F.col("text"), F.col("differ") & (F.col("pages") >= TEXT_SUPPORT * F.col("n"))
            ).otherwise(F.col("pages") >= SUPPORT * F.col("n"))
        )
    )
    alike = frequent.groupBy("host", "pages", "total", "v1", "v2").agg(
        F.min("token").alias("class"),
        F.collect_list(
            F.struct("token", "text", "depth", "main", "aside", "block", "total", "pages")
        ).alias("members"),
    )
    return alike.where(F.size("members") >= LEAST_TOKENS).select(
        "host", "class", F.explode("members").alias("m")
    ).select("host", "class", "m.*")


ORDERS = "host string, class long, token long, low long, high long, chars long"


def _orders(batches):
    """Per host: of each class the least and the greatest hash of its tokens' order in a
    page, and of each element, and the host as token 0, the characters that vary."""
    orders: dict[tuple[str, int], list[int]] = {}
    varying: dict[tuple[str, int], int] = {}
    for batch in batches:
        for page, host, tokens, owners in _rows(batch):
            owner = dict(zip(tokens, owners))
            order: dict[int, dict[int, None]] = {}
            for event in read(page):
                token = event.role if isinstance(event, Element) else run_token(event)
                if token in owner:
                    order.setdefault(owner[token], {})[token] = None
                elif isinstance(event, Run) and not event.holder.aside:
                    for holder in (0, *event.holder.parents):
                        if not holder or holder in owner:
                            key = (host, holder)
                            varying[key] = varying.get(key, 0) + event.plain_chars
            for name, found in order.items():
                h = _hash(" ".join(map(str, found)))
                low_high = orders.setdefault((host, name), [h, h])
                low_high[0], low_high[1] = min(low_high[0], h), max(low_high[1], h)
    rows = [(host, name, None, *ends, None) for (host, name), ends in orders.items()]
    rows += [(host, None, token, None, None, n) for (host, token), n in varying.items()]
    names = [part.split()[0] for part in ORDERS.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 5]
    yield pa.record_batch(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names
    )


def article_slots(tokens: pd.DataFrame) -> list[int]:
    """The elements of a template that hold the article.

    All that hold the whole of the varying text once a page lie in each other;
    the slot is the deepest. Elements with a name are taken instead if they hold
    NAMED_SHARE of that text. None if there is no such element.
    """
    able = tokens[~tokens["text"] & ~tokens["aside"] & (tokens["chars"] > 0)]
    named = able[able["main"]]
    if len(named) and named["chars"].sum() >= NAMED_SHARE * named["host_chars"].iloc[0]:
        return sorted(named["token"])
    whole = able[
        ~able["block"]
        & (able["total"] == able["pages"])
        & (able["chars"] == able["host_chars"])
    ]
    return whole.loc[whole["depth"] == whole["depth"].max(), "token"].tolist()


def _template(tokens: pd.DataFrame) -> pd.DataFrame:
    row = {"host": tokens["host"].iloc[0], "slots": article_slots(tokens)}
    return pd.DataFrame([row])


def templates(pages: DataFrame) -> tuple[DataFrame, int]:
    """host and slots, the template's elements that hold the article; the template's tokens."""
    found = kept(classes(pages))
    n = found.count()
    owners = found.groupBy("host").agg(
        F.collect_list(F.struct("token", "class")).alias("t")
    ).select(F.col("host").alias("_host"), "t.token", "t.class")
    read_again = pages.withColumn("host", host_column(F.col("url")))
    measured = kept(
        read_again.join(_near(owners, n), F.col("host") == F.col("_host"))
        .select("html", "host", "token", "class")
        .mapInArrow(_orders, ORDERS)
        .groupBy("host", "class", "token")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars"))
    )
    ordered = measured.where("low = high").select("host", "class")
    chars = measured.where("token is not null").select("host", "token", "chars")
    whole = chars.where("token = 0").select("host", F.col("chars").alias("host_chars"))
    valid = (
        found.join(ordered, ["host", "class"], "left_semi")
        .join(chars, ["host", "token"])
        .join(whole, "host")
    )
    # A token of a template is in half a host's pages, so a group is no larger than a page or two.
    return kept(valid.groupBy("host").applyInPandas(_template, "host string, slots array<long>")), n


@F.pandas_udf(T.StringType())
def host_column(urls: pd.Series) -> pd.Series:
    return urls.map(host_of)


def page_text(page: str | None, slots: set[int]) -> str:
    """Blocks of the article; a page without the template's slots goes by its own elements."""
    runs = [e for e in read(page) if isinstance(e, Run) and not e.holder.aside]
    held = [r for r in runs if not slots.isdisjoint(r.holder.parents)]
    if not held:
        named = [r for r in runs if r.holder.inside]
        enough = NAMED_SHARE * sum(r.plain_chars for r in runs)
        held = named if named and sum(r.plain_chars for r in named) >= enough else runs
    return "\n\n".join(r.text for r in held)


def _texts(batches):
    for batch in batches:
        texts = [
            page_text(page, set(slots or ())) for page, slots in _rows(batch.select(["html", "slots"]))
        ]
        kept_columns = [batch.column("page_id"), batch.column("url")]
        yield pa.record_batch([*kept_columns, pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """Every page's article: page_id, url, text, n_chars.

    Null or empty html gives an empty text; a null url is a host of its own. A
    page that is the only one of its host, or whose host has only copies of it,
    has nothing to compare with: all its text counts as varying. Repeated
    rows give repeated results, other columns are not read, an empty table gives
    no rows. Pages are read whole.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    found, n = templates(rows)
    found = _near(found.withColumnRenamed("host", "_host"), n)
    return (
        rows.withColumn("host", host_column(F.col("url")))
        .join(found, F.col("host") == F.col("_host"), "left")
        .select("page_id", "url", "html", "slots")
        .mapInArrow(_texts, "page_id long, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
