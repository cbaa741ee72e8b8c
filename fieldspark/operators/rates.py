"""Message rates, last values and process samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions import scores
from fieldspark.functions.text import rate_of


def counts(messages: DataFrame, topic: str = "topic") -> DataFrame:
    return messages.groupBy(topic).agg(F.count("*").alias("n"))


def fixed_window_rate(messages: DataFrame, seconds: float, topic: str = "topic") -> DataFrame:
    """Messages over a sample of fixed length."""
    return messages.groupBy(topic).agg((F.count("*") / F.lit(float(seconds))).alias("hz"))


def interarrival_rate(messages: DataFrame, topic: str = "topic", stamp: str = "stamp") -> DataFrame:
    """(n - 1) / (last - first): one over the mean gap.  Null with fewer than two distinct stamps."""
    span = (F.unix_micros(F.max(stamp)) - F.unix_micros(F.min(stamp))) / 1e6
    return messages.groupBy(topic).agg(F.when(span > 0, (F.count("*") - 1) / span).alias("hz"))


def last_value(messages: DataFrame, columns: list[str], topic: str = "topic", stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """Each topic's last message's columns; the greater id wins among equal stamps."""
    last = F.max_by(F.struct(*columns), F.struct(stamp, order))
    return messages.groupBy(topic).agg(last.alias("last")).select(topic, "last.*")


def first_message_wait(messages: DataFrame, start: Column, timeout: float, topic: str = "topic", stamp: str = "stamp") -> DataFrame:
    """Whether a topic's first message comes within `timeout` seconds of the start."""
    wait = F.min(F.unix_micros(F.col(stamp)) - F.unix_micros(start)) / 1e6
    return messages.where(F.col(stamp) >= start).groupBy(topic).agg(wait.alias("wait_s"), (wait <= timeout).alias("arrived"))


def gaps(messages: DataFrame, topic: str = "topic", stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """Seconds since the topic's message before."""
    before = F.lag(F.unix_micros(F.col(stamp))).over(Window.partitionBy(topic).orderBy(stamp, order))
    return messages.withColumn("gap_s", (F.unix_micros(F.col(stamp)) - before) / 1e6)


def log_rate(lines: DataFrame, pick: str = "first", source: str = "source", order: str = "line_no", text: str = "line") -> DataFrame:
    """The first or the last rate line of each log; 0 for a log without one."""
    rate = rate_of(F.col(text))
    at = F.when(rate.isNotNull(), F.col(order))
    chosen = (F.min_by if pick == "first" else F.max_by)(rate, at)
    return lines.groupBy(source).agg(F.coalesce(chosen, F.lit(0.0)).alias("hz"))


def resources(samples: DataFrame, name: str, per_process: str = "mean") -> DataFrame:
    """Mean CPU percent and MB of processes whose command has `name`; 0 without any.

    per_process: `mean` over samples and processes; `first` process of each sample only; `sum` of a sample's processes.
    """
    own = samples.where(F.col("cmd").contains(name))
    if per_process == "first":
        own = own.groupBy("ts").agg(F.min_by(F.struct("cpu_pct", "rss_kb"), "proc_ord").alias("p")).select("p.*")
    elif per_process == "sum":
        own = own.groupBy("ts").agg(F.sum("cpu_pct").alias("cpu_pct"), F.sum("rss_kb").alias("rss_kb"))
    return own.agg(F.coalesce(F.avg("cpu_pct"), F.lit(0.0)).alias("cpu_pct"), F.coalesce(F.avg(scores.kb_to_mb(F.col("rss_kb"))), F.lit(0.0)).alias("ram_mb"))


def rate_and_cpu(messages: DataFrame, samples: DataFrame, name: str, seconds: float, topic: str = "topic") -> DataFrame:
    """Each topic's rate over one sample of `seconds`, beside the mean CPU percent of the first process called `name` in the same time."""
    cpu = resources(samples, name, per_process="first").select("cpu_pct")  # one row
    return fixed_window_rate(messages, seconds, topic).join(F.broadcast(cpu))


def progress(runs: DataFrame, order: str = "seq") -> DataFrame:
    """`i/n` of each run, in order.  The order is one window: meant for tables of runs, of which an experiment has few."""
    i, n = F.row_number().over(Window.orderBy(order)), F.count("*").over(Window.partitionBy())
    return runs.withColumn("progress", F.concat_ws("/", i.cast("string"), n.cast("string")))


def growth(artifacts: DataFrame, seconds: float) -> DataFrame:
    """Size in MB and MB a minute, from metadata alone."""
    mb = scores.bytes_to_mb(F.col("length"))
    return artifacts.select("path", mb.alias("mb"), scores.mb_per_minute(mb, F.lit(float(seconds))).alias("mb_per_min"))


def throttle(messages: DataFrame, interval_us: int, topic: str = "topic", stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """The first message of each topic in each interval."""
    slot = F.floor(F.unix_micros(F.col(stamp)) / F.lit(interval_us))
    first = F.min_by(F.struct(*messages.columns), F.struct(stamp, order))
    return messages.groupBy(topic, slot.alias("__slot")).agg(first.alias("m")).select("m.*")


def tumbling(messages: DataFrame, length: str, topic: str = "topic", stamp: str = "stamp") -> DataFrame:
    return messages.groupBy(F.window(stamp, length).alias("w"), topic).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), topic, "n")


def replay(messages: DataFrame, rate: float, stamp: str = "stamp") -> DataFrame:
    """Seconds from the first message at which each is played."""
    first = messages.agg(F.min(stamp).alias("__first"))
    return messages.join(F.broadcast(first)).withColumn("play_s", (F.unix_micros(F.col(stamp)) - F.unix_micros("__first")) / 1e6 / rate).drop("__first")


def absences(messages: DataFrame, quiet_us: int, end_us: int, expected: DataFrame | None = None, topic: str = "topic", stamp: str = "stamp") -> DataFrame:
    """topic, kind, at_us: `absent` at the last message before a silence longer than `quiet_us`, `back` at the message that ends it.

    `expected` has topics and the stamps from which they are waited for: one that is never seen is absent since then, and so is one whose first message comes too late; from the first message on
    the stamp has no meaning.  A silence that lasts until `end_us` has no end.  A gap longer than a bucket of that width lies between two buckets, so messages are
    reduced to the first and last of each topic and bucket before they are put in order.  Rows without a stamp are left out.
    """
    t = F.unix_micros(F.col(stamp))
    seen = messages.where(F.col(stamp).isNotNull()).groupBy(topic, F.floor(t / F.lit(quiet_us)).alias("__b")).agg(F.min(t).alias("lo"), F.max(t).alias("hi")).select(topic, "lo", "hi", F.lit(True).alias("seen"))
    if expected is not None:
        start = expected.where(F.col(stamp).isNotNull()).groupBy(topic).agg(F.min(t).alias("lo"))
        seen = seen.unionByName(start.select(topic, "lo", F.col("lo").alias("hi"), F.lit(False).alias("seen")))
    in_order = Window.partitionBy(topic).orderBy("lo", "seen")
    # a wait that begins after the first message is no message
    rows = seen.withColumn("__first", F.row_number().over(in_order)).where(F.col("seen") | (F.col("__first") == 1))
    rows = rows.withColumns({"__before": F.lag("hi").over(in_order), "__next": F.lead("lo").over(in_order)})
    event = lambda kind, at: F.struct(F.lit(kind).alias("kind"), F.col(at).alias("at_us"))
    gone = F.when(F.coalesce("__next", F.lit(end_us)) - F.col("hi") > quiet_us, event("absent", "hi"))
    back = F.when(F.col("lo") - F.col("__before") > quiet_us, event("back", "lo"))
    return rows.select(topic, F.explode(F.array_compact(F.array(gone, back))).alias("e")).select(topic, "e.*")


def keep_last(messages: DataFrame, depth: int, period_us: int, topic: str = "topic", stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """A queue that holds the last `depth` messages of each topic and is emptied every period: topic, slot, n messages that came, dropped, ids of those that were left, oldest first.

    The greater id is the later of equal stamps.  With a depth of 1 only the most recent message counts.  Rows without a stamp are left out.
    """
    t = F.unix_micros(F.col(stamp))
    came = messages.where(F.col(stamp).isNotNull()).select(topic, F.floor(t / F.lit(period_us)).alias("slot"), t.alias("t"), F.col(order).alias("id"))
    newest = came.withColumn("__n", F.row_number().over(Window.partitionBy(topic, "slot").orderBy(F.desc("t"), F.desc("id")))).where(F.col("__n") <= depth)
    left = newest.groupBy(topic, "slot").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "id"))), lambda x: x["id"]).alias("ids"))  # at most `depth`
    counted = came.groupBy(topic, "slot").agg(F.count("*").alias("n"))
    same = (F.col(f"l.{topic}").eqNullSafe(F.col(f"c.{topic}"))) & (F.col("l.slot") == F.col("c.slot"))
    both = counted.alias("c").join(left.alias("l"), same)
    return both.select(f"c.{topic}", "c.slot", "n", F.greatest(F.col("n") - depth, F.lit(0)).alias("dropped"), "ids")
