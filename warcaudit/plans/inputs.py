"""Archive-shaped inputs derived from the star-schema and page tables.

One SQL text per input, with table names in braces, so that Spark and the SQL check read the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

START, END = "1996-01-01", "2001-01-01"
LISTING_ORDER = ("store_time", "filename")
CHECKED_AT = "2024-01-01 00:00:00"

_WARC = """concat('AIT-', l_suppkey, '-TEST-JOB', l_orderkey,
              case when l_quantity = 13 then '-NOSEED' else concat('-SEED', l_partkey) end,
              '-', replace(substr(cast(l_shipdate as string), 1, 10), '-', ''), '000000-0000', l_linenumber, '-h3.warc.gz',
              case when l_quantity = 13 then concat('.', l_partkey) else '' end)"""
_DAY = "substr(cast(l_shipdate as string), 1, 10)"

INPUTS = {
    # Every WARC with store time and size; some names have no seed id.
    "warc_listing": f"""
select {_WARC} as filename,
       cast(l_suppkey as string) as collection,
       cast(l_orderkey as string) as crawl,
       cast(round(l_extendedprice * 100) as bigint) * 100 as size,
       concat({_DAY}, 'T00:00:00Z') as store_time
from {{lineitem}}""",

    # The WARC index: URL and MD5 by file name; some WARCs are not listed.
    "warc_index": f"""
select filename, concat('https://example.org/webdatafile/', filename) as url, md5(filename) as md5
from (select {_WARC} as filename, cast(round(l_extendedprice * 100) as bigint) * 100 as size from {{lineitem}}) w
where size % 1300 <> 0""",

    # Seed report fields: failed calls, missing and unexpected collectors, missing and unmatched relations.
    "seed_reports": """
select cast(p_partkey as string) as seed_id,
       case when p_size = 50 then 500 else 200 end as status,
       case when p_size = 50 then null
            when p_type in ('PROMO', 'STANDARD') then 'Hargrett Rare Book & Manuscript Library'
            when p_type = 'ECONOMY' then 'Map and Government Information Library'
            when p_type in ('MEDIUM', 'SMALL') then 'Richard B. Russell Library for Political Research and Studies'
            when p_size % 2 = 0 then 'Other' end as collector,
       case when p_size = 50 or p_size % 3 = 0 then null
            when p_size % 7 = 0 then 'Unrelated note'
            when p_type in ('PROMO', 'STANDARD') then concat('Hargrett ', substr(p_brand, 7), ': papers')
            when p_type in ('MEDIUM', 'SMALL') then concat('RBRL/', 100 + p_size, ': papers') end as relation,
       case when p_size in (49, 50) then null else p_name end as title
from {part}""",

    # Responses of report calls with failures and empty bodies.
    "report_responses": """
select cast(o_custkey as string) as seed_id, concat('aip-', o_custkey) as aip_id,
       case when o_orderkey % 6 = 0 then 'crawldef' else
       case substr(o_orderpriority, 1, 1) when '1' then 'seed' when '2' then 'seedscope' when '3' then 'collscope'
            when '4' then 'coll' else 'crawljob' end end as report_type,
       cast(o_orderkey as string) as entity_id, o_orderkey as ord,
       case when o_orderkey % 17 = 0 then 500 else 200 end as status,
       case when o_orderstatus = 'P' then '' else concat('id,', o_orderkey) end as body
from {orders}""",

    # Rows of crawl job reports: only the first row counts; some jobs have no report.
    "crawl_jobs": """
select cast(o_orderkey as string) as job_id, cast(o_custkey as string) as crawl_definition, 0 as row
from {orders} where o_orderkey % 11 <> 0
union all
select cast(o_orderkey as string), concat('later-', o_custkey), 1 from {orders} where o_orderkey % 11 <> 0""",

    # Definitions that some seeds already hold.
    "held_definitions": """
select cast(l_partkey as string) as seed_id, cast(o_custkey as string) as crawl_definition
from {lineitem} join {orders} on l_orderkey = o_orderkey where l_quantity = 20""",

    # Processing messages.
    "seed_events": """
select cast(user_id as string) as seed_id, event_id as ord,
       case event_type when 'click' then 'Metadata_Report_Errors' when 'view' then 'Metadata_Report_Empty'
            when 'error' then 'WARC_Download_Errors' when 'purchase' then 'WARC_Fixity_Errors'
            else 'WARC_Unzip_Errors' end as log_column,
       case when event_id % 97 = 0 then concat('Error: item ', event_id)
            when event_type = 'view' then concat('report', event_id, '.csv')
            else concat('Successfully processed ', event_id) end as message
from {events}""",

    # What a folder per seed holds for the window: missing WARCs and reports, stray files, unexpected folders.
    "stored_files": f"""
select cast(l_partkey as string) as folder,
       concat('AIT-', l_suppkey, '-TEST-JOB', l_orderkey, '-SEED', l_partkey, '-',
              replace({_DAY}, '-', ''), '000000-0000', l_linenumber, '-h3.warc') as name
from {{lineitem}} where l_quantity <> 13 and l_orderkey % 400 <> 0 and l_partkey % 9 <> 0
  and l_shipdate >= date '{START}' and l_shipdate < date '{END}'
union all select cast(p_partkey as string), concat('aip-', p_partkey, '_coll.csv') from {{part}} where p_size <> 7 and p_partkey % 9 <> 0
union all select cast(p_partkey as string), concat('aip-', p_partkey, '_seed.csv') from {{part}} where p_size <> 8 and p_partkey % 9 <> 0
union all select cast(p_partkey as string), concat('aip-', p_partkey, '_seedscope.csv') from {{part}} where p_size % 4 = 0 and p_partkey % 9 <> 0
union all select cast(p_partkey as string), concat('aip-', p_partkey, '_collscope.csv') from {{part}} where p_size % 5 = 0 and p_partkey % 9 <> 0
union all select cast(p_partkey as string), concat('aip-', p_partkey, '_', p_size, '_crawldef.csv') from {{part}} where p_partkey % 9 <> 0
union all select cast(p_partkey as string), concat('aip-', p_partkey, '_', p_size + 1, '_crawljob.csv') from {{part}} where p_partkey % 9 <> 0
union all select cast(p_partkey as string), 'notes.txt' from {{part}} where p_size = 11 and p_partkey % 9 <> 0
union all select concat('extra', p_partkey), 'x.warc' from {{part}} where p_size = 12""",

    # What the same store held at an earlier audit: some files not there yet, some since gone.
    "earlier_files": """
select folder, name from (select *, try_cast(folder as bigint) % 10 as digit from {stored}) f where coalesce(digit, 0) <> 3 or name not like '%csv'
union all select cast(p_partkey as string), 'old.txt' from {part} where p_partkey % 10 = 5
union all select concat('gone', p_partkey), 'y.warc' from {part} where p_size = 13""",

    # The seed log that the audit reads: some seeds are missing from it, some are in it twice.
    "audit_log": """
select concat('aip-', p_partkey) as AIP_ID, cast(p_partkey as string) as Seed_ID, 2 as WARCs,
       case when p_size = 21 then 'Error: report' else 'Successfully downloaded all metadata reports' end as Metadata_Report_Errors,
       case when p_size % 4 = 0 and p_size % 5 = 0 then 'No empty reports'
            when p_size % 4 = 0 then concat('aip-', p_partkey, '_collscope.csv')
            when p_size % 5 = 0 then concat('aip-', p_partkey, '_seedscope.csv')
            when p_size = 22 then concat('aip-', p_partkey, '_seedscope.csv')
            when p_size = 23 then concat('aip-', p_partkey, '_seedscope.csv; aip-', p_partkey, '_collscope.csv; aip-', p_partkey, '_coll.csv')
            else concat('aip-', p_partkey, '_seedscope.csv; aip-', p_partkey, '_collscope.csv') end as Metadata_Report_Empty,
       case when p_size % 3 = 0 then 'No login columns to redact' when p_size = 31 then 'No seeds.csv to redact'
            else 'Successfully redacted' end as Seed_Report_Redaction,
       case when p_size = 41 then 'Successfully downloaded a; API Error 404: can''t download b'
            else 'Successfully downloaded a; Successfully downloaded b' end as WARC_Download_Errors,
       'Successfully verified a; successfully verified b' as WARC_Fixity_Errors,
       'Successfully unzipped a; Successfully unzipped b' as WARC_Unzip_Errors
from {part} where p_partkey % 50 <> 3
union all
select concat('aip-', p_partkey), cast(p_partkey as string), 2, 'TBD', 'TBD', 'TBD', 'TBD', 'TBD', 'TBD'
from {part} where p_partkey % 50 = 4""",

    # File bytes and listed MD5: some wrong, some not listed.
    "payloads": """
select concat('P', page_id, '.warc.gz') as filename, page_id, html as content,
       case when page_id % 7 = 0 then 'xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx'
            when page_id % 11 = 0 then null else md5(html) end as listed_md5
from {pages}""",

    # Seed reports: none, only a user name, no login columns, both login columns.
    "seed_responses": """
select cast(c_custkey as string) as seed_id, concat('aip-', c_custkey) as aip_id, 'seed' as report_type,
       cast(c_custkey as string) as entity_id, c_custkey as ord, case when c_custkey % 4 = 0 then 404 else 200 end as status,
       case c_custkey % 4 when 0 then concat('login_password', chr(10), c_name)
            when 1 then concat('id,login_username', chr(10), c_custkey, ',', c_name, chr(10))
            when 2 then concat('id,collection', chr(10), c_custkey, ',', c_nationkey, chr(10))
            else concat('id,login_username,login_password,collection', chr(10), c_custkey, ',', c_name, ',', c_mktsegment, ',',
                        c_nationkey, chr(10)) end as body
from {customer}""",

    # Landed answers as JSON lines: some cut off, some with a status that is no number, some that are no record.
    "landed_lines": """
select o_orderkey, o_custkey, case when o_orderkey % 13 = 0 then substr(whole, 1, length(whole) - 5)
            when o_orderkey % 17 = 0 then replace(whole, ' 200,', ' "no",') when o_orderkey % 19 = 0 then 'null'
            when o_orderkey % 23 = 0 then replace(whole, 'entity_id', 'other_id') else whole end as line,
       o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0 and o_orderkey % 19 <> 0 and o_orderkey % 23 <> 0 as good
from (select o_orderkey, o_custkey, concat(chr(123), '"report_type": "seed", "entity_id": "', o_orderkey, '", "status": 200, "body": "id,', o_custkey, '"', chr(125))
      as whole from {orders}) w""",

    # Landed listing pages with one file each, some of them an error page instead.
    "landed_pages": """
select concat('page-', c_custkey, '.json') as name, c_custkey % 7 <> 0 as good, concat('A-SEED', c_custkey, '-1.warc.gz') as filename,
       case when c_custkey % 7 = 0 then concat('<html>', c_name, '</html>')
            else concat(chr(123), '"count": 1,', chr(10), ' "files": [', chr(123), '"filename": "A-SEED', c_custkey, '-1.warc.gz", "size": ', c_custkey, chr(125), ']', chr(125)) end as body
from {customer} where c_custkey <= 500""",

    # A landed batch: its WARCs. Some are outside the window, not landed, not gzip, or listed with another MD5.
    "batch_warcs": """
select page_id, seed, collection, job, concat('page-', seed % 10, '.json') as page,
       concat('AIT-', collection, '-TEST-JOB', job, '-SEED', seed, '-20230410000000-', page_id, '-h3.warc.gz') as filename,
       length(html) * 1000 as size, case when page_id % 31 = 0 then '2023-07-01T00:00:00Z' else '2023-04-20T00:00:00Z' end as store_time,
       html as content, page_id % 31 <> 0 as inside, page_id % 13 <> 0 as landed, page_id % 17 <> 0 as zipped, page_id % 19 <> 0 as same
from (select page_id, html, page_id - page_id % 5 as seed, page_id - page_id % 3 as job, (page_id - page_id % 5) % 7 as collection from {pages}) p""",

    # Answers to the report calls of that batch: none for some jobs, failed and empty ones for some seeds and collections.
    "batch_answers": """
select 'seed' as report_type, cast(seed as string) as entity_id, case when seed % 3 = 2 then 404 else 200 end as status,
       case seed % 3 when 0 then concat('url,login_password', chr(10), 'x,PASS', chr(10)) when 1 then concat('url', chr(10), 'x', chr(10)) else '' end as body
from (select distinct page_id - page_id % 5 as seed from {pages}) s
union all select 'seedscope', cast(seed as string), 200, case when seed % 2 = 0 then '' else concat('scope', chr(10), 'a', chr(10)) end
from (select distinct page_id - page_id % 5 as seed from {pages}) s
union all select 'coll', cast(c as string), 200, concat('id', chr(10), c, chr(10)) from (select distinct (page_id - page_id % 5) % 7 as c from {pages}) c
union all select 'collscope', cast(c as string), 200, case when c in (1, 3) then '' else concat('scope', chr(10), 'all', chr(10)) end
from (select distinct (page_id - page_id % 5) % 7 as c from {pages}) c
union all select 'crawljob', cast(job as string), 200, concat('id,crawl_definition', chr(10), job, ',', 9000 + job % 11, chr(10))
from (select distinct page_id - page_id % 3 as job from {pages}) j where job % 14 <> 0
union all select distinct 'crawldef', cast(9000 + (page_id - page_id % 3) % 11 as string), 200, concat('id', chr(10), '9', chr(10)) from {pages}""",

    # What a store holds: files of seeds, files in folders deeper down, and folders without files, which have no name here.
    "store_paths": """
select cast(p_partkey as string) as folder, concat('aip-', p_partkey, case when p_size % 2 = 0 then '_coll.csv' else ' #1%.csv' end) as name,
       repeat('x', p_size) as body from {part} where p_size <> 9
union all select cast(p_partkey as string), concat('more/', p_partkey, '.txt'), p_name from {part} where p_size = 3
union all select cast(p_partkey as string), null, null from {part} where p_size = 9""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, read as it lies."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """The same dealt out by a key: a small file is one split, and one core would make all texts of a derived input."""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(spark, folder, name).repartition(tasks, key)


def derive(spark: SparkSession, folder: str, text: str, **given: DataFrame) -> DataFrame:
    """Run a text with table names in braces over the given tables."""
    used = {name: given.get(name) if name in given else table(spark, folder, name)
            for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


INPUTS["earlier_files"] = INPUTS["earlier_files"].replace("{stored}", f"({INPUTS['stored_files']})")


def load(spark: SparkSession, folder: str, name: str, **given: DataFrame) -> DataFrame:
    """One of the derived inputs."""
    return derive(spark, folder, INPUTS[name], **given)


def listing_between(spark: SparkSession, folder: str, start: str, end: str) -> DataFrame:
    """The listing with the store window asked of the source, so that the scan skips other row groups."""
    rows = table(spark, folder, "lineitem").filter(f"l_shipdate >= timestamp_ntz'{start}' and l_shipdate < timestamp_ntz'{end}'")
    return derive(spark, folder, INPUTS["warc_listing"], lineitem=rows)


def with_clause(*names: str) -> str:
    """The same inputs as a WITH clause over views named like the tables."""
    plain = {name: name for name in TABLES}
    return "with " + ",\n".join(f"{name} as ({INPUTS[name].format(**plain)})" for name in names)
