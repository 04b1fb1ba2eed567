"""Packages: built once, kept as they were made, and seen by readers when they are sent.

Layout under a delivery root that all executors share:

    <root>/<kind>/build=<id>/business_date=YYYY-MM-DD/            the rows of one build; never changed
    <root>/packages/<kind>/<business date>/<version>.json         what became of a package: a small file for each step

A step is made, sending or sent. It names the build that holds the rows, and their
number, control totals and digest. A package's steps are numbered, and a step is
published under the next number, which only one of several writers gets
(``sources.files.publish_once``): that is all the locking there is. Readers take the
rows of the last build that was sent. So a package that is built again shows its old
rows until the new ones are complete and sent, one that was made but not sent is sent
later as it was made, and nobody sees a part.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from despacho.functions.dates import Day, age_in_days, compact_text, day
from despacho.functions.quantities import TOTAL
from despacho.operators.control import INDICATOR, VALUE, totals
from despacho.sources.files import exists, publish_once

LEDGER = "kind string, business_date date, sent_at timestamp_ntz"
MADE, SENDING, SENT = "made", "sending", "sent"
STEP = (
    "kind string, business_date date, version long, state string, build string, file_format string, content string,"
    " n_rows long, totals map<string, string>, digest string, created date, package_name string, at timestamp_ntz"
)
ABANDONED = dt.timedelta(hours=1)  # a sending without an end is taken up again


@dataclass(frozen=True)
class Kind:
    """One dataset: its short name and the columns its control totals cover."""

    name: str
    counted: str
    summed: str | None = None


# Dataset names.
SALES = Kind("vta", "Cantidad", "Cantidad")
STOCK = Kind("inv", "Cantidad", "Cantidad")
CUSTOMERS = Kind("mc", "IdCliente")

Controls = Mapping[str, Decimal]


@dataclass(frozen=True)
class Package:
    """A package as one of its steps describes it."""

    kind: str
    business_date: dt.date
    version: int
    state: str
    build: str
    file_format: str
    content: str  # the schema of its rows, as JSON
    n_rows: int
    totals: dict[str, str]
    digest: str
    created: dt.date
    package_name: str | None
    at: dt.datetime

    @property
    def controls(self) -> Controls:
        return {name: Decimal(value) for name, value in self.totals.items()}

    @property
    def key(self) -> tuple[str, dt.date]:
        return self.kind, self.business_date


def package_name(user: Column, kind: Column, business_date: Column) -> Column:
    """``<user>_<kind>_<yyyyMMdd>``."""
    return F.concat_ws("_", user, kind, compact_text(business_date))


def literal_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    """A few rows given as literals, in one partition."""
    structs = (F.struct(*(F.lit(value).alias(name) for name, value in row.items())) for row in rows)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def read_records(spark: SparkSession, schema: str, *folders: str) -> DataFrame:
    """What ``publish_once`` published under some folders; no rows if nothing was yet."""
    found = [folder for folder in folders if exists(spark, folder)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(found)


def steps(spark: SparkSession, root: str, kinds: Iterable[str] | None = None, days: Sequence[dt.date] | None = None) -> DataFrame:
    """All steps of packages, of some kinds and business dates only if these are named."""
    if kinds is None:
        folders = [f"{root}/packages"]
    elif days is None:
        folders = [f"{root}/packages/{kind}" for kind in kinds]
    else:
        folders = [f"{root}/packages/{kind}/{d:%Y-%m-%d}" for kind in kinds for d in days]
    return read_records(spark, STEP, *folders)


def _last(all_steps: DataFrame) -> DataFrame:
    """The last step of each package."""
    last = F.max_by(F.struct(*all_steps.columns), "version").alias("last")
    return all_steps.groupBy("kind", "business_date").agg(last).select("last.*")


def packages(all_steps: DataFrame) -> dict[tuple[str, dt.date], Package]:
    """The last step of each package: a few rows a day."""
    found = (Package(**row.asDict(recursive=True)) for row in _last(all_steps).collect())
    return {p.key: p for p in found}


def _publish(spark: SparkSession, root: str, step: Package) -> bool:
    path = f"{root}/packages/{step.kind}/{step.business_date:%Y-%m-%d}/{step.version:08d}.json"
    return publish_once(spark, path, json.dumps(asdict(step), default=lambda value: value.isoformat()))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def rows_of(spark: SparkSession, root: str, chosen: Iterable[Package]) -> DataFrame:
    """The rows of packages of one kind with their business date, wherever they were built."""
    by_layout: dict[tuple[str, str], list[Package]] = {}
    for p in chosen:
        by_layout.setdefault((p.file_format, p.content), []).append(p)
    frames = []
    for (file_format, content), members in by_layout.items():
        schema = StructType([*StructType.fromJson(json.loads(content)).fields, StructField("business_date", DateType())])
        filled = [f"{root}/{p.kind}/build={p.build}/business_date={p.business_date:%Y-%m-%d}" for p in members if p.n_rows]
        if filled:
            reader = spark.read.format(file_format).schema(schema).option("basePath", f"{root}/{members[0].kind}")
            reader = reader.option("header", "true") if file_format == "csv" else reader
            frames.append(reader.load(filled).select(*schema.names))
        else:
            frames.append(spark.createDataFrame([], schema))
    return reduce(DataFrame.unionByName, frames)


def delivered(spark: SparkSession, root: str, kind: Kind, schema: StructType, file_format: str = "parquet") -> DataFrame:
    """Rows of a dataset (columns as in ``schema``) that were sent, with their business date."""
    sent = packages(steps(spark, root, [kind.name]).filter(F.col("state") == SENT))
    dated = StructType([*schema.fields, StructField("business_date", DateType())])
    if not sent:
        return spark.createDataFrame([], dated)
    return rows_of(spark, root, sent.values()).select(*dated.names)


def content_digest(columns: Sequence[str]) -> Column:
    """An aggregate that tells tables of different rows apart, in whatever order they come."""
    values = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(28,0)")).cast("string") for seed in (1, 2)]
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums)


NO_ROWS = "0"


def _by_day(rows: DataFrame, sums: Mapping[str, Column]) -> dict[dt.date, dict]:
    """The digest of each day and some aggregates, in one pass over the rows."""
    content = [c for c in rows.columns if c != "business_date"]
    found = rows.groupBy("business_date").agg(content_digest(content).alias("digest"), *(c.alias(n) for n, c in sums.items()))
    return {r["business_date"]: r.asDict() for r in found.collect()}


def build_days(
    df: DataFrame, root: str, kind: Kind, days: Sequence[dt.date], file_format: str = "parquet", created: dt.date | None = None
) -> list[Package]:
    """Write the rows of several days, told apart by ``business_date``, into a folder of their own.

    One write for all; the rebalance splits a large package over many files and
    joins small ones. Rows are counted and summed while they are written; a
    difference from the control totals, which are taken from the rows read
    back, is an error. What is returned has no version yet: nobody sees it.
    """
    spark, build = df.sparkSession, uuid.uuid4().hex
    observed = Observation(f"deliver_{kind.name}_{build}")
    content = df.drop("business_date").schema
    business_date = F.col("business_date")
    expected = {
        (d, name): value
        for d in days
        for name, value in totals(df, kind.counted, kind.summed, business_date == day(d)).items()
    }
    metrics = [c.alias(f"{name} {d}") for (d, name), c in expected.items()]
    metrics += [F.count(F.when(business_date == day(d), 1)).alias(f"rows {d}") for d in days]
    rows = df.filter(business_date.isin(*map(day, days))).hint("rebalance").observe(observed, *metrics)
    writer = rows.write.format(file_format).partitionBy("business_date")
    writer = writer.option("header", "true") if file_format == "csv" else writer
    writer.save(f"{root}/{kind.name}/build={build}")

    empty = Package(
        kind.name, days[0], 0, MADE, build, file_format, content.json(), 0, {}, NO_ROWS, created or _now().date(), None, _now()
    )
    written = [replace(empty, business_date=d, n_rows=observed.get[f"rows {d}"]) for d in days]
    sums = totals(df, kind.counted, kind.summed)
    read = _by_day(rows_of(spark, root, written), sums)
    result = []
    for p in written:
        found = read.get(p.business_date, {})
        controls = {n: found.get(n, Decimal("0.00")) for n in sums}
        for n in sums:
            as_written = Decimal(observed.get[f"{n} {p.business_date}"])
            if controls[n] != as_written:
                raise RuntimeError(f"{kind.name}: {n} of {p.business_date} written {as_written}, read back {controls[n]}")
        result.append(
            replace(p, totals={n: str(v) for n, v in controls.items()}, digest=found.get("digest", NO_ROWS))
        )
    return result


def make(spark: SparkSession, root: str, built: Iterable[Package], seen: Mapping[tuple[str, dt.date], int]) -> list[Package]:
    """Publish built packages as made, each as the step behind the version that was seen before it was built.

    A package that somebody else moved on meanwhile is left as it is, and not among
    those returned.
    """
    steps = [replace(p, version=seen.get(p.key, 0) + 1, state=MADE, at=_now()) for p in built]
    return [p for p in steps if _publish(spark, root, p)]


Transport = Callable[[Package, DataFrame], None]


def copy_to(folder: str) -> Transport:
    """Hand packages over as folders ``<folder>/<package name>``."""

    def transport(package: Package, rows: DataFrame) -> None:
        writer = rows.drop("business_date").write.format(package.file_format).mode("overwrite")
        writer = writer.option("header", "true") if package.file_format == "csv" else writer
        writer.save(f"{folder}/{package.package_name}")

    return transport


def send(
    spark: SparkSession, root: str, made: Iterable[Package], user: str | None = None, transport: Transport | None = None
) -> list[Package]:
    """Send packages as they were made; those that somebody else sends meanwhile are left to them.

    The rows are taken from the build and compared with the digest of when they were
    made. If that or the transport fails, the package is made, not sent, again.
    """
    claimed = []
    for p in made:
        name = f"{user}_{p.kind}_{p.business_date:%Y%m%d}" if user else p.package_name
        step = replace(p, version=p.version + 1, state=SENDING, package_name=name, at=_now())
        if _publish(spark, root, step):
            claimed.append(step)
    done, open_ = [], {p.key: p for p in claimed}
    try:
        for kind in dict.fromkeys(p.kind for p in claimed):
            of_kind = [p for p in claimed if p.kind == kind]
            found = _by_day(rows_of(spark, root, of_kind), {})
            for p in of_kind:
                digest = found.get(p.business_date, {}).get("digest", NO_ROWS)
                if digest != p.digest:
                    raise RuntimeError(f"{p.kind} of {p.business_date} isn't as it was made")
                if transport:
                    transport(p, rows_of(spark, root, [p]))
                sent = replace(p, version=p.version + 1, state=SENT, at=_now())
                if _publish(spark, root, sent):  # not if it took so long that somebody took it up again
                    done.append(sent)
                del open_[p.key]
    finally:
        for p in open_.values():
            _publish(spark, root, replace(p, version=p.version + 1, state=MADE, at=_now()))
    return done


def is_waiting(package: Package) -> bool:
    """Whether a package was made and nobody is sending it."""
    return package.state == MADE or package.state == SENDING and _now() - package.at > ABANDONED


def waiting(spark: SparkSession, root: str, as_of: Day, max_age: int, kinds: Sequence[str]) -> list[Package]:
    """Packages of some kinds that were made at most ``max_age`` days before the run date, and not sent."""
    last = _last(steps(spark, root, kinds))
    recent = last.filter((F.col("state") != SENT) & (age_in_days(as_of, F.col("created")) <= max_age))
    return [p for p in packages(recent).values() if is_waiting(p)]


def deliver_days(
    df: DataFrame, root: str, kind: Kind, days: Sequence[dt.date], file_format: str = "parquet"
) -> dict[dt.date, Controls]:
    """Build, make and send the packages of several days in place of any that were sent before."""
    spark = df.sparkSession
    left = build_days(df, root, kind, days, file_format)
    sent: list[Package] = []
    while left:
        seen = {key: p.version for key, p in packages(steps(spark, root, [kind.name], days)).items()}
        sent += send(spark, root, make(spark, root, left, seen))
        done = {p.key for p in sent}
        left = [p for p in left if p.key not in done]
    return {p.business_date: p.controls for p in sorted(sent, key=lambda p: p.business_date)}


def deliver(df: DataFrame, root: str, kind: Kind, business_date: dt.date, file_format: str = "parquet") -> Controls:
    """One package with its control totals."""
    dated = df.withColumn("business_date", day(business_date))
    return deliver_days(dated, root, kind, [business_date], file_format)[business_date]


def _sent(spark: SparkSession, root: str) -> DataFrame:
    return _last(steps(spark, root).filter(F.col("state") == SENT))


def verification(spark: SparkSession, root: str) -> DataFrame:
    """Control totals of every package sent."""
    rows = _sent(spark, root).select("kind", "business_date", F.explode("totals").alias(INDICATOR, VALUE))
    return rows.withColumn(VALUE, F.col(VALUE).cast(TOTAL))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """What was sent, when, and under which name."""
    return _sent(spark, root).select("kind", "business_date", F.col("at").alias("sent_at"), "package_name")
