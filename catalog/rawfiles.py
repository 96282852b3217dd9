"""Raw files written from the test tables.

Every table goes out whole. A file is a folder `file_nm=<name>` with one part;
files hold a range of keys, so that their number grows with the table. Some
rows are broken on purpose, by what their columns say. Files are written once
per session and table folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table
from rawgate.session import scratch_path

_WRITTEN: dict[tuple[str, str, str], str] = {}

FIRST, SECOND, THIRD, LAST = -3, -2, -1, 2**62

# rows of orders that are written in a special way
SHORT = "(o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"
LONG = "(o_orderpriority = '2-HIGH')"
QUOTED = "(o_orderpriority = '3-MEDIUM')"
LOWER = "(o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O')"
EMPTY_QUOTES = "(o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F')"
MALFORMED = "(o_orderpriority = '5-LOW' AND o_orderstatus = 'F')"
NUL = "(o_orderpriority = '5-LOW' AND o_orderstatus = 'O')"
INNER_QUOTE = "(o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')"

# SQL that names the same things, for the expected results
ORDERS_SQL = f"""o AS (
  SELECT *, 'orders_' || lpad(CAST(o_orderkey // 1000 AS VARCHAR), 6, '0') || '.csv' AS file_nm,
    o_orderkey // 1000 AS file_no,
    CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS ck,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total,
    strftime(o_orderdate, '%Y-%m-%d') AS d,
    {SHORT} AS is_short, {LONG} AS is_long, {MALFORMED} AS is_malformed, {LOWER} AS is_lower,
    CASE WHEN {QUOTED} THEN 'said "yes"|no ' || CAST(o_custkey AS VARCHAR)
         WHEN {EMPTY_QUOTES} THEN ''
         WHEN {NUL} THEN 'nul'
         WHEN {INNER_QUOTE} THEN '5" pipe'
         ELSE 'plain' END AS note
  FROM orders)"""


#: files land without checksum files beside them, which on a local file system cost as much to make as the files do
LANDED = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], DataFrame], **options: str) -> str:
    """Folder with the lines (file_nm, ord, value) of `make` in order.

    Writing takes time by the number of files more than by their bytes, so the number of tasks is
    fixed: merged by size, the tasks would be few, with thousands of files each.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN:
        path = scratch_path(spark, f"raw-{label}")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        lines = make().repartition(tasks, "file_nm").sortWithinPartitions("file_nm", "ord")
        lines.select("file_nm", "value").write.partitionBy("file_nm").options(**LANDED, **options).text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _file(prefix: str, key: str, per_file: int, suffix: str = "csv") -> str:
    return f"concat('{prefix}_', lpad(cast({key} div {per_file} as string), 6, '0'), '.{suffix}')"


def fixed_lines(files: DataFrame, *lines: tuple[int, str]) -> DataFrame:
    """The same lines for every file, from one pass over `files`; each line is (ord, SQL expression)."""
    each = [F.struct(F.lit(order).cast("bigint").alias("ord"), F.expr(text).alias("value")) for order, text in lines]
    return files.select("file_nm", F.inline(F.array(*each)))


def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "*",
        F.expr(_file("orders", "o_orderkey", 1000)).alias("file_nm"),
        F.expr("o_orderkey div 1000").alias("file_no"),
        F.expr("cast(cast(o_totalprice as decimal(18,2)) as string)").alias("total"),
        F.expr("date_format(o_orderdate, 'yyyy-MM-dd')").alias("d"),
    )


def orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two header lines, a blank line, D rows and a trailer with count and total."""
    rows = orders_rows(spark, sf_dir)
    note = f"""CASE WHEN {QUOTED} THEN concat('"said ""yes""|no ', o_custkey, '"')
      WHEN {EMPTY_QUOTES} THEN '""'
      WHEN {MALFORMED} THEN '"x"y'
      WHEN {NUL} THEN concat('nu', char(0), 'l')
      WHEN {INNER_QUOTE} THEN '5" pipe'
      ELSE 'plain' END"""
    data = rows.select(
        "file_nm",
        F.col("o_orderkey").alias("ord"),
        F.expr(f"""concat(CASE WHEN {LOWER} THEN 'd' ELSE 'D' END, '|', o_orderkey, '|', o_custkey, '|',
          o_orderstatus, '|', total, '|', d,
          CASE WHEN {SHORT} THEN '' ELSE concat('|', o_orderpriority, '|', {note}) END,
          CASE WHEN {LONG} THEN '|more' ELSE '' END)""").alias("value"),
    )
    files = rows.groupBy("file_nm", "file_no").agg(
        F.count("*").alias("n"),
        F.expr(f"coalesce(sum(CASE WHEN {SHORT} OR {MALFORMED} THEN 0 ELSE cast(o_totalprice as decimal(18,2)) END), 0)").alias("s"),
    )
    edges = fixed_lines(
        files,
        (FIRST, "'H|20240101'"),
        (SECOND, "'H|ORDERKEY|CUSTKEY|STATUS|TOTAL|ORDERDATE|PRIORITY|NOTE'"),
        (THIRD, "''"),
        # every fifth file declares one row and one unit too many
        (LAST, "concat('T|', n + if(file_no % 5 = 3, 1, 0), '|', s + if(file_no % 5 = 3, 1, 0))"),
    )
    return edges.unionByName(data)


def orders_files(spark: SparkSession, sf_dir: str) -> str:
    return write_once(spark, sf_dir, "orders", lambda: orders_lines(spark, sf_dir))


def orders_gzip(spark: SparkSession, sf_dir: str) -> str:
    return write_once(spark, sf_dir, "orders-gz", lambda: orders_lines(spark, sf_dir), compression="gzip")


FIXED_NAMES = ["ORDERKEY", "CUSTKEY", "STATUS", "TOTAL", "ORDERDATE", "PRIORITY"]
FIXED_LENGTHS = [12, 10, 1, 16, 10, 15]
FIXED_SQL = f"""f AS (
  SELECT *, lpad(k, 12, '0') || lpad(ck, 10, '0') || o_orderstatus || lpad(total, 16, ' ') || d
    || rpad(replace(o_orderpriority, ' ', ','), 15, ' ') AS whole,
    CASE WHEN {SHORT} THEN substr(whole, 1, 40) WHEN {LONG} THEN whole || 'ZZZ' ELSE whole END AS body
  FROM o)"""


def fixed_width_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders_rows(spark, sf_dir).withColumn(
        "whole",
        F.expr("""concat(lpad(o_orderkey, 12, '0'), lpad(o_custkey, 10, '0'), o_orderstatus, lpad(total, 16, ' '), d,
          rpad(replace(o_orderpriority, ' ', ','), 15, ' '))"""),
    )
    body = f"CASE WHEN {SHORT} THEN substr(whole, 1, 40) WHEN {LONG} THEN concat(whole, 'ZZZ') ELSE whole END"
    data = rows.select("file_nm", F.col("o_orderkey").alias("ord"), F.expr(f"concat('D', {body})").alias("value"))
    files = rows.groupBy("file_nm").agg(F.count("*").alias("n"))
    edges = fixed_lines(
        files,
        (FIRST, "'H20240101'"),
        (SECOND, f"'H{''.join(FIXED_NAMES)}'"),
        (LAST, "concat('T', lpad(n, 10, '0'))"),
    )
    return edges.unionByName(data)


def fixed_width_files(spark: SparkSession, sf_dir: str) -> str:
    return write_once(spark, sf_dir, "orders-fixed", lambda: fixed_width_lines(spark, sf_dir))


PARTS_SQL = """p AS (
  SELECT *, 'parts_' || lpad(CAST(p_partkey // 250 AS VARCHAR), 6, '0') || '.csv' AS file_nm,
    CAST(p_partkey AS VARCHAR) || '|' || p_name || '|' || p_brand AS line FROM part)"""


def parts_files(spark: SparkSession, sf_dir: str) -> str:
    """No identifiers: two header lines, data, the row count; a blank line after the headers."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "part").withColumn("file_nm", F.expr(_file("parts", "p_partkey", 250)))
        data = rows.select(
            "file_nm", F.col("p_partkey").alias("ord"), F.expr("concat(p_partkey, '|', p_name, '|', p_brand)").alias("value")
        )
        files = rows.groupBy("file_nm").agg(F.count("*").alias("n"))
        edges = fixed_lines(
            files, (FIRST, "'20240101'"), (SECOND, "'PARTKEY|NAME|BRAND'"), (THIRD, "''"), (LAST, "cast(n as string)")
        )
        return edges.unionByName(data)

    return write_once(spark, sf_dir, "parts", make)


CUSTOMERS_SQL = """c AS (
  SELECT *, 'customers_' || lpad(CAST(c_custkey // 200 AS VARCHAR), 6, '0') || '.csv' AS file_nm,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS bal FROM customer)"""


def manual_files(spark: SparkSession, sf_dir: str) -> str:
    """No identifiers at all: column names, then data."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "customer").withColumn("file_nm", F.expr(_file("customers", "c_custkey", 200)))
        data = rows.select(
            "file_nm",
            F.col("c_custkey").alias("ord"),
            F.expr("concat(c_custkey, '|', c_name, '|', cast(c_acctbal as decimal(18,2)))").alias("value"),
        )
        return fixed_lines(rows.select("file_nm").distinct(), (FIRST, "'CustKey|Name|Acct Bal'")).unionByName(data)

    return write_once(spark, sf_dir, "customers", make)


def xml_files(spark: SparkSession, sf_dir: str) -> str:
    def make() -> DataFrame:
        rows = table(spark, sf_dir, "customer").withColumn("file_nm", F.expr(_file("customers", "c_custkey", 200, "xml")))
        data = rows.select(
            "file_nm",
            F.col("c_custkey").alias("ord"),
            F.expr("""concat('<row><CUSTKEY>', c_custkey, '</CUSTKEY><NAME>', c_name, ' &amp; co</NAME>',
              CASE WHEN c_nationkey < 5 THEN '' ELSE concat('<SEGMENT>', c_mktsegment, '</SEGMENT>') END, '</row>')""").alias("value"),
        )
        files = rows.select("file_nm").distinct()
        return fixed_lines(files, (FIRST, "'<rows>'"), (LAST, "'</rows>'")).unionByName(data)

    return write_once(spark, sf_dir, "customers-xml", make)


def nested_xml_files(spark: SparkSession, sf_dir: str) -> str:
    """The same rows: some hold another row, end tags with blanks, or tags in comments and CDATA sections."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "customer").withColumn("file_nm", F.expr(_file("nested", "c_custkey", 200, "xml")))
        data = rows.select(
            "file_nm",
            F.col("c_custkey").alias("ord"),
            F.expr("""concat(if(c_nationkey % 5 = 4, '<!-- <row><CUSTKEY>no</CUSTKEY></row> -->', ''), '<row><CUSTKEY>', c_custkey, '</CUSTKEY>',
              CASE c_nationkey % 5 WHEN 1 THEN '<row><NAME>inner</NAME></row >' WHEN 2 THEN '<!-- </row><row> -->' ELSE '' END,
              '<NAME>', c_name, ' &amp; co</NAME><SEGMENT>', if(c_nationkey % 5 = 3, '<![CDATA[</row> & <row>]]>', c_mktsegment), '</SEGMENT>',
              if(c_nationkey % 5 = 0, '</row >', '</row>'))""").alias("value"),
        )
        return fixed_lines(rows.select("file_nm").distinct(), (FIRST, "'<rows>'"), (LAST, "'</rows>'")).unionByName(data)

    return write_once(spark, sf_dir, "customers-xml-nested", make)


# layout of a file of customers, by nation: H rows, column header flag, D marks
LAYOUTS = {
    0: (0, "N", False),
    1: (0, "N", True),
    2: (1, "N", False),
    3: (1, "N", True),
    4: (1, "Y", True),
    5: (2, "N", True),
    6: (0, "Y", False),
    7: (2, "Y", True),
}


def layout_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of customers of one nation and hundred keys, in eight layouts."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "customer").withColumn("v", F.expr("c_nationkey % 8")).withColumn(
            "file_nm", F.expr("concat('v', v, '_', c_custkey div 250, '.csv')")
        )
        marked = ", ".join(str(v) for v, (_, _, d) in LAYOUTS.items() if d)
        heads1 = ", ".join(str(v) for v, (h, _, _) in LAYOUTS.items() if h >= 1)
        heads2 = ", ".join(str(v) for v, (h, _, _) in LAYOUTS.items() if h >= 2)
        data = rows.select(
            "file_nm",
            F.col("c_custkey").alias("ord"),
            F.expr(f"concat(if(v IN ({marked}), 'D|', ''), c_custkey, '|', c_name)").alias("value"),
        )
        files = rows.groupBy("file_nm", "v").agg(F.count("*").alias("n"))
        head1 = fixed_lines(files.filter(f"v IN ({heads1})"), (FIRST, "if(v = 4, 'H|CUSTKEY|NAME', 'H|20240101')"))
        head2 = fixed_lines(files.filter(f"v IN ({heads2})"), (SECOND, "'H|CUSTKEY|NAME'"))
        names = fixed_lines(files.filter("v = 6"), (FIRST, "'CUSTKEY|NAME'"))
        tails = fixed_lines(files.filter("v <> 6"), (LAST, "concat('T|', n)"))
        return head1.unionByName(head2).unionByName(names).unionByName(tails).unionByName(data)

    return write_once(spark, sf_dir, "layouts", make)


# rows of events that do not have five fields
EVENT_BAD = "event_type IN ('error', 'signup')"


def events_files(spark: SparkSession, sf_dir: str) -> str:
    """Single-line CSV with `'` around JSON; errors lack a field, signups have one too many."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "events").withColumn("file_nm", F.expr(_file("events", "event_id", 2000)))
        data = rows.select(
            "file_nm",
            F.col("event_id").alias("ord"),
            F.expr("""concat('D;', event_id, ';', event_type, ';''', props, '''',
              CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'signup' THEN ';1;2' ELSE ';1' END)""").alias("value"),
        )
        files = rows.groupBy("file_nm").agg(F.count("*").alias("n"))
        return fixed_lines(files, (FIRST, "'H;ID;TYPE;PROPS;FLAG'"), (LAST, "concat('T;', n, ';;;')")).unionByName(data)

    return write_once(spark, sf_dir, "events", make)


def _quoted(col: str) -> str:
    return f"""concat('"', replace(coalesce({col}, ''), '"', '""'), '"')"""


def documents_files(spark: SparkSession, sf_dir: str) -> str:
    """Multi-line CSV: H row, rows without an indicator, T row."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "documents").withColumn("file_nm", F.expr(_file("documents", "doc_id", 50)))
        data = rows.select(
            "file_nm",
            F.col("doc_id").alias("ord"),
            F.expr(f"concat(doc_id, '|', lang, '|', {_quoted('source')}, '|', {_quoted('text')})").alias("value"),
        )
        files = rows.groupBy("file_nm").agg(F.count("*").alias("n"))
        return fixed_lines(files, (FIRST, "'H|20240101||'"), (LAST, "concat('T|', n, '||')")).unionByName(data)

    return write_once(spark, sf_dir, "documents", make)


# documents in files with improper quotes
DIRTY_SQL = """d AS (SELECT *, doc_id % 10 = 3 OR doc_id % 50 = 49 AS bad,
    lang || CASE doc_id % 10 WHEN 5 THEN ' 5" pipe' WHEN 7 THEN chr(13) || 'x' ELSE '' END AS tongue FROM documents)"""


def dirty_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents as before; some rows have text behind a closing quote, a quote or a carriage return inside a cell, or a quote without an end."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "documents").withColumn("file_nm", F.expr(_file("dirty", "doc_id", 50)))
        tongue = "concat(lang, CASE doc_id % 10 WHEN 5 THEN ' 5\" pipe' WHEN 7 THEN concat(char(13), 'x') ELSE '' END)"
        text = f"CASE WHEN doc_id % 50 = 49 THEN '\"open' WHEN doc_id % 10 = 3 THEN concat({_quoted('text')}, 'tail') ELSE {_quoted('text')} END"
        value = F.expr(f"concat(doc_id, '|', {tongue}, '|', {_quoted('source')}, '|', {text})")
        data = rows.select("file_nm", F.col("doc_id").alias("ord"), value.alias("value"))
        return fixed_lines(rows.groupBy("file_nm").agg(F.count("*").alias("n")), (LAST, "concat('T|', n, '||')")).unionByName(data)

    return write_once(spark, sf_dir, "documents-dirty", make)


def conversations_files(spark: SparkSession, sf_dir: str) -> str:
    """Multi-line CSV without identifiers: names, rows, row count."""

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "conversations").withColumn("file_nm", F.expr(_file("conversations", "conv_id", 50)))
        data = rows.select(
            "file_nm",
            F.expr("conv_id * 1000000 + turn").alias("ord"),
            F.expr(f"concat(conv_id, '|', turn, '|', role, '|', {_quoted('text')})").alias("value"),
        )
        files = rows.groupBy("file_nm").agg(F.count("*").alias("n"))
        return fixed_lines(files, (FIRST, "'CONV|TURN|ROLE|TEXT'"), (LAST, "concat(n, '|||')")).unionByName(data)

    return write_once(spark, sf_dir, "conversations", make)
