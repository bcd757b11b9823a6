"""URL filters with dated lists: every capture is judged by the entries of its day.

List entries say that from a day on a domain is blocked, allowed, or no longer listed. Those
of one domain become intervals, each until the domain's next entry. A capture asks for its
host and for all domains above it; the most specific entry that holds on the day of the
capture decides.

The as-of join is an equi-join on (domain, month) with the days compared inside. For every month
that captures ask of a domain, one window per domain carries the interval that holds when it
begins; intervals that begin in a month are added to it. So an interval costs a row per month
asked, however long it is, the captures of one hot host spread over the months, and the skew join
splits what is left. A window holds the list's entries of a domain and the months asked of it.

Hosts are read as browsers read them: what stands before the last ``@`` of the authority, the port
and dots at the end are no part of it, a backslash ends it like a slash, and case does not count.

Cases: a null or odd url has no host and is kept as ``unlisted``; a null day, or one that is no
number, matches nothing, and any number is a day, however far off; entries with a null in any
column are left out; of several entries of one domain and day the last in order of action
counts (remove, block, allow); repeated captures are each judged; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triples.llm.common import table
from spark_triples.session import stage

#: A month of the join has two to the power of this many days.
MONTH_BITS = 5
_RANK = {"remove": 0, "block": 1, "allow": 2}


_HOST = r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#\\]*@)?([^/?#\\:]*)"


def _domain(name: Column) -> Column:
    """A domain as it is compared: in lower case, without dots at its end."""
    return F.rtrim(F.lower(name), F.lit("."))


def host_of(url: Column) -> Column:
    return _domain(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _HOST, 1))


def domains(host: Column) -> Column:
    """The host and the domains above it, of two labels at least, the most specific first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(
        n >= 2,
        F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.array_join(F.slice(labels, k, n), ".")),
    ).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, action, since, until): until is the day before which an entry holds, or null.

    ``entries`` has domain, day (days since 1970) and action. A domain has one entry a day at most
    when its rows meet, so the window is bounded by the days of the list.
    """
    rank = F.create_map(*[F.lit(x) for pair in _RANK.items() for x in pair])
    daily = (
        entries.select(
            _domain(F.col("domain")).alias("domain"),
            F.col("day").try_cast("long").alias("since"),
            F.lower("action").alias("action"),
        )
        .filter(F.col("domain").isNotNull() & F.col("since").isNotNull() & F.col("action").isin(*_RANK))
        .groupBy("domain", "since")
        .agg(F.max(F.struct(rank[F.col("action")].alias("rank"), "action"))["action"].alias("action"))
    )
    later = Window.partitionBy("domain").orderBy("since")
    return daily.withColumn("until", F.lead("since").over(later)).filter("action <> 'remove'")


def _month(day: str) -> Column:
    return F.shiftright(day, MONTH_BITS)


def by_month(held: DataFrame, asked: DataFrame) -> DataFrame:
    """(domain, month, action, since, until): for every (domain, month) in ``asked``, the intervals
    that hold on some day of it."""
    entry = F.struct("action", "since", "until").alias("entry")
    begins = F.shiftleft("month", MONTH_BITS)
    marks = asked.select("domain", "month").distinct()
    line = held.select("domain", F.lit(None).cast("long").alias("month"), F.col("since").alias("at"), entry)
    line = line.unionByName(marks.select("domain", "month", begins.alias("at")), allowMissingColumns=True)
    past = Window.partitionBy("domain").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    carried = line.withColumn("entry", F.last("entry", ignorenulls=True).over(past))
    carried = carried.filter(F.col("month").isNotNull() & F.col("entry").isNotNull()).select("domain", "month", "entry.*")
    # an interval that begins with its month is carried into it already
    own = held.withColumn("month", _month("since")).filter(F.shiftleft("month", MONTH_BITS) < F.col("since"))
    return carried.unionByName(own.select(*carried.columns))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, host, day, verdict, domain, since) of every capture.

    ``captures`` has page_id, url and day. The verdict is block, allow or unlisted.
    """
    held = intervals(entries)
    known = captures.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("day").try_cast("long").alias("day"),
    ).withColumn("host", host_of(F.col("url")))
    known = stage(known, "captures")
    asked = known.filter(F.col("day").isNotNull()).select(
        "row", "day", _month("day").alias("month"), F.posexplode(domains(F.col("host"))).alias("level", "domain")
    )
    cut = by_month(held, asked)
    found = (
        asked.join(cut, ["domain", "month"])
        .filter((F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until"))))
        .groupBy("row")
        .agg(F.min(F.struct("level", "domain", "action", "since")).alias("hit"))
    )
    return known.join(found, "row", "left").select(
        "page_id",
        "url",
        "host",
        "day",
        F.coalesce("hit.action", F.lit("unlisted")).alias("verdict"),
        "hit.domain",
        "hit.since",
    )


def _draw(text: Column) -> Column:
    """A number below 2**24 that SQL engines agree on."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("long")


def derive(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and a dated list as the pages imply them: pages were fetched in the course of 2024, in
    order of a number drawn from their url; every host and the domain above it was listed some
    day, most were removed again, and some came back."""
    first_day = 19_723  # 2024-01-01
    captures = pages.select("page_id", "url", (first_day + _draw(F.coalesce("url", F.lit(""))) % 366).alias("day"))
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct()
    names = hosts.select(F.explode(F.slice(domains(F.col("host")), 1, 2)).alias("domain")).distinct()
    draw = _draw(F.col("domain"))
    action = F.when(draw % 5 == 0, "allow").otherwise("block")
    added = first_day - 60 + draw % 365
    entry = F.array(
        F.struct(added.alias("day"), action.alias("action")),
        F.struct((added + 30 + draw % 97).alias("day"), F.lit("remove").alias("action")),
        F.struct((added + 130 + draw % 89).alias("day"), F.when(draw % 3 == 0, "remove").otherwise("block").alias("action")),
    )
    entries = names.select("domain", F.explode(entry).alias("e")).select("domain", "e.day", "e.action")
    return captures, entries


def op10_temporal_lists(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page by the list of its day."""
    return judge(*derive(table(spark, sf_dir, "pages")))


OP10_SQL = r"""
WITH captures AS (
  SELECT page_id, url, 19723 + CAST('0x' || substr(md5(coalesce(url, '')), 1, 6) AS BIGINT) % 366 AS day,
         rtrim(lower(regexp_extract(coalesce(url, ''),
           '^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#\\]*@)?([^/?#\\:]*)', 1)), '.') AS host
  FROM pages
),
hosts AS (SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures),
levels AS (
  SELECT host, unnest(range(1, len(labels))) AS level, labels FROM hosts WHERE len(labels) >= 2
),
asked AS (SELECT host, level, array_to_string(labels[level:], '.') AS domain FROM levels),
names AS (SELECT DISTINCT domain FROM asked WHERE level <= 2),
draws AS (SELECT domain, CAST('0x' || substr(md5(domain), 1, 6) AS BIGINT) AS draw FROM names),
entries AS (
  SELECT domain, 19663 + draw % 365 AS day, CASE WHEN draw % 5 = 0 THEN 'allow' ELSE 'block' END AS action FROM draws
  UNION ALL SELECT domain, 19663 + draw % 365 + 30 + draw % 97, 'remove' FROM draws
  UNION ALL SELECT domain, 19663 + draw % 365 + 130 + draw % 89, CASE WHEN draw % 3 = 0 THEN 'remove' ELSE 'block' END FROM draws
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY domain, day ORDER BY
    CASE action WHEN 'allow' THEN 0 WHEN 'block' THEN 1 ELSE 2 END) AS k FROM entries
),
held AS (
  SELECT domain, action, day AS since, lead(day) OVER (PARTITION BY domain ORDER BY day) AS until
  FROM ranked WHERE k = 1
),
hits AS (
  SELECT c.page_id, h.domain, h.action, h.since,
         row_number() OVER (PARTITION BY c.page_id ORDER BY a.level) AS k
  FROM captures c JOIN asked a ON a.host = c.host
  JOIN held h ON h.domain = a.domain AND h.action <> 'remove' AND h.since <= c.day AND (h.until IS NULL OR c.day < h.until)
)
SELECT c.page_id, c.url, c.host, c.day, coalesce(h.action, 'unlisted') AS verdict, h.domain, h.since
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id AND h.k = 1
"""
