"""The same queries as plain SQL, written independently of the operators."""

from __future__ import annotations

from .inputs import CHECKED_AT, END, START, with_clause

_YEAR, _MONTH = END[:4], END[5:7]

_DUCK_GB = """(({b} // 1000000 + case when {b} % 1000000 > 500000
        or ({b} % 1000000 = 500000 and ({b} // 1000000) % 2 = 1) then 1 else 0 end)::double / 1000.0)"""


def _gb(value: str) -> str:
    return _DUCK_GB.format(b=value)


_SEED = r"nullif(regexp_extract(filename, '^.*-SEED(\d+)-', 1), '')"

_LISTED = f"""rows_in as (select *, {_SEED} as seed_id, substr(store_time, 1, 10) as store_date from warc_listing),
placed as (select * from rows_in where seed_id is not null),
inside as (select * from placed where store_date >= '{START}' and store_date < '{END}')"""

_INVENTORY = f"""{_LISTED},
jobs as (select seed_id, crawl, min(store_time || ' ' || filename) as o from inside group by all),
colls as (select seed_id, collection, min(store_time || ' ' || filename) as o from inside group by all),
job_lists as (select seed_id, string_agg(crawl, '|' order by o) as job_list from jobs group by seed_id),
coll_lists as (select seed_id, string_agg(collection, '|' order by o) as coll_list from colls group by seed_id),
sums as (select seed_id, sum(size)::bigint as b, count(*) as n,
                string_agg(filename, '|' order by store_time, filename) as names from inside group by seed_id),
seeds as (select s.seed_id as Seed_ID, coll_list as AIT_Collection, job_list as Job_ID, {_gb('b')} as Size_GB,
                 n as WARCs, names as WARC_Filenames, 'TBD' as Metadata_Report_Errors, 'TBD' as Metadata_Report_Empty,
                 'TBD' as Seed_Report_Redaction, 'TBD' as WARC_Download_Errors, 'TBD' as WARC_Fixity_Errors,
                 'TBD' as WARC_Unzip_Errors, 'TBD' as Complete
          from sums s join job_lists using (seed_id) join coll_lists using (seed_id))"""

_DEPARTMENTS = r"""dept as (select *, case when status <> 200 then 'TBD: API error ' || status
        when collector is null then 'TBD: no collector in Archive-It'
        when collector = 'Hargrett Rare Book & Manuscript Library' then 'hargrett'
        when collector = 'Map and Government Information Library' then 'magil'
        when collector = 'Richard B. Russell Library for Political Research and Studies' then 'russell'
        else 'TBD: unexpected collector value' end as department from seed_reports),
coll as (select *, case when status <> 200 then 'TBD'
        when department = 'hargrett' then case when regexp_matches(relation, '^Hargrett (.*):')
            then 'harg-' || regexp_extract(relation, '^Hargrett (.*):', 1) else 'harg-0000' end
        when department = 'magil' then 'magil-0000'
        when department = 'russell' then case when regexp_matches(relation, '^RBRL/(\d{3})')
            then 'rbrl-' || regexp_extract(relation, '^RBRL/(\d{3})', 1) else 'rbrl-000' end
        else 'TBD: unexpected department value' end as archival_collection,
        case when status <> 200 then 'TBD' else coalesce(title, 'TBD: could not get title from Archive-It') end as aip_title
        from dept),
numbered as (select *, row_number() over (partition by archival_collection order by seed_id) as n from coll)"""

_METADATA = f"""{_DEPARTMENTS},
meta as (select department as Department, archival_collection as Collection, seed_id as Folder,
        case when department = 'magil' then 'magil-ggp-' || seed_id || '-{_YEAR}-{_MONTH}'
             when department in ('hargrett', 'russell')
             then archival_collection || '-web-{_YEAR}{_MONTH}-' || case when n < 10000 then lpad(n::varchar, 4, '0') else n::varchar end
             else 'TBD' end as AIP_ID, aip_title as Title, '1' as Version from numbered)"""

_COLUMNS = ("Metadata_Report_Errors", "Metadata_Report_Empty", "WARC_Download_Errors", "WARC_Fixity_Errors",
            "WARC_Unzip_Errors")
_FOLD = "folded as (select seed_id as Seed_ID, 'TBD' as Seed_Report_Redaction, " + ", ".join(
    f"coalesce(string_agg(message, '; ' order by ord) filter (log_column = '{c}'), 'TBD') as {c}" for c in _COLUMNS
) + " from seed_events group by seed_id)"
_FOLD_OUT = ("Seed_ID, Metadata_Report_Errors, Metadata_Report_Empty, Seed_Report_Redaction, WARC_Download_Errors, "
             "WARC_Fixity_Errors, WARC_Unzip_Errors")

_STATUSES = ("Metadata_Report_Errors", "Metadata_Report_Empty", "Seed_Report_Redaction", "WARC_Download_Errors",
             "WARC_Fixity_Errors", "WARC_Unzip_Errors", "Complete")

_FOUND = "concat_ws('; ', " + ", ".join(
    f"case when contains({c}, 'Error') then '{c}' end"
    for c in ("Metadata_Report_Errors", "WARC_Download_Errors", "WARC_Fixity_Errors", "WARC_Unzip_Errors")) + ")"

_EVENT_LOG = f"""{_FOLD},
totals as (select seed_id as Seed_ID, sum(ord * 1000500)::bigint as b,
                  count(*) filter (log_column = 'WARC_Download_Errors') as WARCs from seed_events group by seed_id),
log as (select 'aip-' || Seed_ID as AIP_ID, '7' as AIT_Collection, null::varchar as Job_ID, {_gb('b')} as Size_GB, WARCs,
               'a|b' as WARC_Filenames, {_FOLD_OUT},
               case when {_FOUND} <> '' then {_FOUND} else 'Successfully completed' end as Complete
        from folded join totals using (Seed_ID))"""

_HALF = f"""{_FOLD},
half as (select *, case Seed_ID::bigint % 5 when 0 then 'TBD' when 1 then null when 2 then '  '
                   else 'WARC_Download_Errors' end as Complete from folded)"""

_EXPECTED = f"""{_LISTED},
once as (select Seed_ID as seed_id, min(AIP_ID) as aip_id from audit_log group by Seed_ID having count(*) = 1),
expected as (select seed_id, aip_id, count(*) as warcs, min(store_time || ' ' || filename) as o
             from inside join once using (seed_id) group by all)"""

_ENDINGS = ("_coll.csv", "_collscope.csv", "_crawldef.csv", "_crawljob.csv", "_seed.csv", "_seedscope.csv", ".warc")
_KNOWN = " or ".join(f"ends_with(name, '{e}')" for e in _ENDINGS)
_AUDIT = f"""{_EXPECTED},
joined as (select e.*, f.folder, f.name from expected e left join stored_files f on f.folder = e.seed_id),
tested as (select seed_id, aip_id, warcs, o, count(folder) > 0 as folder_made,
        {", ".join(f"coalesce(bool_or(name = aip_id || '_{k}.csv'), false) as has_{k}" for k in ("coll", "collscope", "seed", "seedscope"))},
        {", ".join(f"count(*) filter (ends_with(name, '_{k}.csv')) as {k}_count" for k in ("crawldef", "crawljob"))},
        count(*) filter (ends_with(name, '.warc')) as found, bool_and({_KNOWN}) as known
        from joined group by all),
audit as (select seed_id, aip_id, folder_made,
        {", ".join(f"case when folder_made then has_{k} end as has_{k}" for k in ("coll", "collscope", "seed", "seedscope"))},
        {", ".join(f"case when folder_made then {k}_count end as {k}_count" for k in ("crawldef", "crawljob"))},
        case when folder_made then found = warcs end as warc_count_correct,
        case when folder_made then known end as file_types_expected,
        case when folder_made then 'present' else 'missing' end as state from tested),
extras as (select distinct folder from stored_files
           where folder <> 'metadata.csv' and folder not in (select Seed_ID from audit_log))"""

_HEADERS = (("Seed Folder Made", "folder_made"), ("coll.csv", "has_coll"), ("collscope.csv", "has_collscope"),
            ("seed.csv", "has_seed"), ("seedscope.csv", "has_seedscope"), ("crawldef.csv count", "crawldef_count"),
            ("crawljob.csv count", "crawljob_count"), ("WARC Count Correct", "warc_count_correct"),
            ("All Expected File Types", "file_types_expected"))


def _word(column: str) -> str:
    if column.endswith("_count"):
        text = f"{column}::varchar"
    else:
        text = f"case when {column} then 'True' else 'False' end"
    return text if column == "folder_made" else f"case when state = 'missing' then 'missing' else {text} end"


def _successes(column: str) -> str:
    return f"((length({column}) - length(replace(lower({column}), 'successfully', ''))) // 12)::integer"


_WARC_COLUMNS = ("WARC_Download_Errors", "WARC_Fixity_Errors", "WARC_Unzip_Errors")
_ALL_SUCCESSFUL = " and ".join(f"{_successes(c)} = WARCs" for c in _WARC_COLUMNS)

# File names of reports.
_REPORT_NAME = """case when report_type in ('crawljob', 'crawldef') then aip_id || '_' || entity_id || '_' || report_type || '.csv'
    else aip_id || '_' || report_type || '.csv' end"""


def all_oracles() -> dict[str, str]:
    listing = with_clause("warc_listing")
    return {
        "listing_scan": f"""{listing}
select filename as page, 0 as position, 2::bigint as declared, filename, collection, crawl, size, store_time,
       'https://example.org/' || filename as url, md5(filename) as md5 from warc_listing
union all
select filename, 1, 2, 'second-' || filename, collection, crawl, size + 1, store_time, null, null from warc_listing""",

        "seed_report_scan": f"""{with_clause('seed_reports')}
select seed_id, status, collector, relation as relation_first,
       case when relation is not null then 'See ' || seed_id end as relation_last, title from seed_reports""",

        "report_scan": """
select o_orderkey, 0::bigint as row, unnest(['id', 'crawl_definition', 'note']) as name,
       unnest([o_orderkey::varchar, o_custkey::varchar, 'a, "b"' || chr(10) || 'next']) as value
from orders where o_orderkey % 2 = 0
union all
select o_orderkey, 1, unnest(['id', 'crawl_definition', 'note']), unnest([(o_orderkey + 1)::varchar, null, 'plain'])
from orders where o_orderkey % 2 = 0
union all
select o_orderkey, 0, unnest(['id', 'login_password']), unnest([o_orderkey::varchar, o_orderpriority])
from orders where o_orderkey % 2 = 1""",

        "log_scan": f"{with_clause('seed_events')}, {_EVENT_LOG} select * from log",
        "log_sink": f"""{with_clause('seed_events')}, {_EVENT_LOG}
select * replace (Size_GB::varchar as Size_GB, WARCs::varchar as WARCs) from log""",

        "log_segments": f"""{with_clause('seed_events')}, {_EVENT_LOG},
states as (select *, ((Seed_ID::bigint % 2 = 0 or Seed_ID::bigint % 3 = 0) and Seed_ID::bigint % 10 <> 0) or Seed_ID::bigint % 20 = 0 as done from log)
select AIP_ID, Seed_ID, AIT_Collection, Job_ID, Size_GB::varchar as Size_GB, WARCs::varchar as WARCs, WARC_Filenames,
       {", ".join(f"case when done then {c} else 'TBD' end as {c}" for c in _STATUSES)} from states""",
        "quarantine": f"""{with_clause('landed_lines', 'landed_pages')}
select 'answer' as source, o_orderkey::varchar as name, length('id,' || o_custkey) as chars, sha256('id,' || o_custkey) as sha256 from landed_lines where good
union all select 'listed', filename, substr(name, 6, length(name) - 10)::bigint, null from landed_pages where good
union all select 'response line', null, length(line), sha256(line) from landed_lines where not good
union all select 'listing page', name, length(body), sha256(body) from landed_pages where not good""",
        "file_listing": f"""{with_clause('store_paths')}
select folder, name, strlen(body) as length, false as is_folder from store_paths where name is not null
union all select distinct folder, null, null::bigint, true from store_paths
union all select folder, 'more', null, true from store_paths where name like 'more/%'""",
        "metadata_sink": f"""{with_clause('seed_reports')}, {_METADATA}
select *, row_number() over (order by case when Department = 'magil' then 1 when Department in ('hargrett', 'russell') then 2 else 3 end,
                                      Folder)::integer as line from meta""",
        "report_sink": f"""{with_clause('report_responses')}
select seed_id as folder, {_REPORT_NAME} as name, strlen(body) as length from report_responses where status = 200 and body <> ''""",

        "seed_id_extract": f"{listing} select filename, {_SEED} as seed_id from warc_listing",
        "store_date": f"{listing} select filename, split_part(store_time, 'T', 1) as store_date from warc_listing",
        "date_window": f"{listing}, {_LISTED} select filename, seed_id, store_date from inside",
        "rejects": f"""{listing}, {_LISTED}
select filename, store_date, 'no seed id in file name' as reason from rows_in where seed_id is null""",
        "seed_sizes": f"""{listing}, {_LISTED},
sums as (select seed_id, sum(size)::bigint as bytes, count(*) as warcs from placed group by seed_id)
select *, {_gb('bytes')} as size_gb from sums""",
        "seed_inventory": f"{listing}, {_INVENTORY} select * from seeds",
        "explode_lists": f"""{listing}, {_LISTED},
jobs as (select seed_id, crawl, min(store_time || ' ' || filename) as o from placed group by all)
select seed_id as Seed_ID, (row_number() over (partition by seed_id order by o) - 1)::integer as position, crawl as job_id from jobs""",
        "expected_seeds": f"{with_clause('warc_listing', 'audit_log')}, {_EXPECTED} select seed_id, aip_id, warcs from expected",
        "reconcile": f"""{with_clause('warc_listing', 'audit_log')}, {_EXPECTED},
numbers as (select (select count(*) from lineitem) as declared,
        (select count(*) from inside where seed_id in (select seed_id from once)) as included,
        (select count(*) from placed) as placed_rows, (select count(*) from rows_in where seed_id is null) as rejected)
select declared, included, placed_rows - included as excluded, rejected, declared = placed_rows as reconciled from numbers""",

        "departments": f"{with_clause('seed_reports')}, {_DEPARTMENTS} select seed_id, department, aip_title from coll",
        "collections": f"{with_clause('seed_reports')}, {_DEPARTMENTS} select seed_id, archival_collection from coll",
        "sequence": f"""{with_clause('seed_reports')}, {_DEPARTMENTS}
select seed_id, archival_collection, n::integer as sequence,
       case when n < 10000 then lpad(n::varchar, 4, '0') else n::varchar end as sequence_text
from numbered where department in ('hargrett', 'russell')""",
        "aip_metadata": f"{with_clause('seed_reports')}, {_METADATA} select * from meta",
        "enrich": f"""{with_clause('warc_listing', 'seed_reports')}, {_INVENTORY}, {_METADATA}
select AIP_ID, seeds.* from seeds left join meta on Folder = Seed_ID""",

        "classify_reports": f"""{with_clause('report_responses')},
named as (select *, {_REPORT_NAME} as report_name from report_responses)
select seed_id, report_name, case when status <> 200 then 'error' when body = '' then 'empty' else 'saved' end as outcome,
       case when status <> 200 then 'Metadata_Report_Errors' when body = '' then 'Metadata_Report_Empty' end as log_column,
       case when status <> 200 then report_name || ' API Error ' || status when body = '' then report_name end as message
from named""",
        "report_names": f"""{with_clause('report_responses')}
select entity_id, report_type, {_REPORT_NAME} as report_name from report_responses""",
        "reports_by_seed": f"""{with_clause('report_responses')}
select seed_id, {_REPORT_NAME} as report_name, case when status <> 200 then 'error' when body = '' then 'empty' else 'saved' end as outcome,
       case when seed_id::bigint % 7 = 0 then 'again' end as redaction from report_responses where seed_id::bigint % 11 <> 0""",
        "crawl_definitions": f"""{with_clause('warc_listing', 'crawl_jobs', 'held_definitions')}, {_LISTED},
needed as (select distinct seed_id, crawl as job_id from placed),
linked as (select n.seed_id, n.job_id, j.crawl_definition from needed n
           left join (select * from crawl_jobs where row = 0) j using (job_id))
select seed_id, 'definition' as kind, crawl_definition, null::varchar as job_id, null::varchar as message
from (select distinct seed_id, crawl_definition from linked where crawl_definition is not null
      except select seed_id, crawl_definition from held_definitions) d
union all
select seed_id, 'error', null, job_id,
       'Error: crawl job ' || job_id || ' was not downloaded so can''t get crawl definition id'
from linked where crawl_definition is null""",
        "redact": f"""{with_clause('seed_responses')}
select seed_id, aip_id || '_seed.csv' as report_name,
       case c when 0 then null when 3 then 'id,login_username,login_password,collection' || chr(10) || seed_id
           || ',REDACTED,REDACTED,' || split_part(split_part(body, chr(10), 2), ',', 4) || chr(10) else body end as body,
       case c when 0 then 'No seeds.csv to redact' when 3 then 'Successfully redacted' else 'No login columns to redact' end as message
from (select *, seed_id::bigint % 4 as c from seed_responses) r""",

        "warc_locations": f"""{with_clause('warc_listing', 'warc_index')}
select l.filename, i.url, i.md5,
       case when i.url is null then 'Index Error: cannot get the WARC URL or MD5 for ' || l.filename end as message
from warc_listing l left join (select distinct filename, url, md5 from warc_index) i on i.filename = l.filename""",
        "fixity": f"""{with_clause('payloads')},
pairs as (select filename, listed_md5 as md5, case when page_id % 10 <> 3 then md5(content) end as actual_md5 from payloads),
judged as (select *, case when md5 is null then 'not listed' when actual_md5 is null then 'not computable'
                     when md5 = actual_md5 then 'verified' else 'changed' end as outcome from pairs)
select *, case outcome when 'verified' then 'Successfully verified ' || filename || ' fixity on {CHECKED_AT}.000000'
    when 'changed' then 'Error: fixity for ' || filename || ' changed and it was deleted: ' || md5 || ' before, ' || actual_md5 || ' after'
    when 'not computable' then 'Error: fixity for ' || filename || ' cannot be extracted from md5deep output: b''''' end as message
from judged""",
        "decompress": f"""{with_clause('payloads')},
tried as (select *, case when page_id % 13 = 0 then 'unexpected end of file' when page_id % 17 = 0 then 'not in gzip format' end as reason,
                 page_id % 7 <> 0 and page_id % 19 <> 0 as same from payloads)
select filename, case when same and reason is null then md5(content) end as unzipped_md5,
       case when same and reason is null then strlen(content) end as unzipped_size,
       case when same and reason is null then 'Successfully unzipped ' || filename
            when same then 'Error unzipping ' || filename || ': ' || reason end as message from tried""",
        "whole_run": f"""{with_clause('batch_warcs')},
listed as (select *, seed % 4 <> 0 as known, case when seed % 4 = 0 then 'TBD' else 'magil-ggp-' || seed || '-2023-05' end as aip from batch_warcs where inside),
jobs as (select seed, aip, job, min(page_id) as o from listed group by all),
job_errors as (select seed, string_agg(aip || '_' || job || '_crawljob.csv API Error 404; Error: crawl job ' || job
                   || ' was not downloaded so can''t get crawl definition id', '; ' order by o) as text from jobs where job % 14 = 0 group by seed),
files as (select *, 'Successfully downloaded ' || filename as got, 'API Error 404: can''t download ' || filename as missed,
                 case when landed and same then case when zipped then 'Successfully unzipped ' || filename
                      else 'Error unzipping ' || filename || ': not in gzip format' end end as unzip from listed),
seeds as (select f.seed, aip, known, collection, sum(size)::bigint as b, count(*) as n, string_agg(filename, '|' order by page_id) as names,
                 (select string_agg(job::varchar, '|' order by o) from jobs j where j.seed = f.seed) as job_list,
                 concat_ws('; ', case when f.seed % 3 = 2 then aip || '_seed.csv API Error 404' end, any_value(e.text)) as report_errors,
                 concat_ws('; ', case when f.seed % 2 = 0 then aip || '_seedscope.csv' end, case when collection in (1, 3) then aip || '_collscope.csv' end) as empties,
                 string_agg(case when landed then got else missed end, '; ' order by page_id) as downloads,
                 bool_or(not landed) as download_error, bool_or(landed and not same) as fixity_error,
                 string_agg(unzip, '; ' order by page_id) as unzips, bool_or(landed and same and not zipped) as unzip_error
          from files f left join job_errors e on e.seed = f.seed group by f.seed, aip, known, collection),
judged as (select *, concat_ws('; ', case when report_errors <> '' then 'Metadata_Report_Errors' end, case when download_error then 'WARC_Download_Errors' end,
                  case when fixity_error then 'WARC_Fixity_Errors' end, case when unzip_error then 'WARC_Unzip_Errors' end) as found from seeds)
select aip as AIP_ID, seed::varchar as Seed_ID, collection::varchar as AIT_Collection, job_list as Job_ID, ({_gb('b')})::varchar as Size_GB, n::varchar as WARCs,
       names as WARC_Filenames, case when report_errors = '' then 'Successfully downloaded all metadata reports' else report_errors end as Metadata_Report_Errors,
       case when empties = '' then 'No empty reports' else empties end as Metadata_Report_Empty,
       case seed % 3 when 0 then 'Successfully redacted' when 1 then 'No login columns to redact' else 'No seeds.csv to redact' end as Seed_Report_Redaction,
       downloads as WARC_Download_Errors, coalesce(unzips, 'TBD') as WARC_Unzip_Errors,
       case when found = '' then 'Successfully completed' else found end as Complete from judged""",
        "warc_stage_outcomes": f"""{with_clause('payloads')},
a as (select *, md5(content) as actual, case when page_id % 23 = 0 then 'not located' when listed_md5 is null then 'not located'
        when page_id % 13 = 0 then 'not downloaded' when page_id % 17 = 0 then 'fixity unknown'
        when listed_md5 <> md5(content) then 'fixity changed' when page_id % 19 = 0 then 'not unzipped' else 'done' end as outcome
      from payloads)
select filename, outcome,
       case when page_id % 23 = 0 then 'API Error 503: can''t get info about ' || filename
            when outcome = 'not located' then 'Index Error: cannot get the WARC URL or MD5 for ' || filename
            when outcome = 'not downloaded' then 'API Error 404: can''t download ' || filename
            else 'Successfully downloaded ' || filename end as download_message,
       case when outcome = 'fixity unknown' then 'Error: fixity for ' || filename || ' cannot be extracted from md5deep output: b'''''
            when outcome = 'fixity changed' then 'Error: fixity for ' || filename || ' changed and it was deleted: ' || listed_md5 || ' before, ' || actual || ' after'
            when outcome in ('not unzipped', 'done') then 'Successfully verified ' || filename || ' fixity on {CHECKED_AT}.000000' end as fixity_message,
       case when outcome = 'not unzipped' then 'Error unzipping ' || filename || ': unexpected end of file'
            when outcome = 'done' then 'Successfully unzipped ' || filename end as unzip_message
from a""",

        "fold_log": f"{with_clause('seed_events')}, {_FOLD} select {_FOLD_OUT} from folded",
        "completeness_status": f"""{with_clause('seed_events')}, {_FOLD},
judged as (select Seed_ID, {_FOUND} as found,
                  case when Seed_ID::bigint % 5 = 0 then 'Looked at by hand' else 'TBD' end as earlier from folded)
select Seed_ID, case when found = '' and earlier = 'TBD' then 'Successfully completed' when found = '' then earlier
                     when earlier = 'TBD' then found else earlier || '; ' || found end as Complete from judged""",
        "completeness_events": f"""{with_clause('seed_events')}, {_FOLD}
select Seed_ID, case when {_FOUND} = '' then 'Successfully completed' else {_FOUND} end as Complete from folded""",
        "pending": f"""{with_clause('seed_events')}, {_HALF}
select Seed_ID, Complete from half where Complete is null or trim(Complete) in ('', 'TBD')""",
        "pending_batch": f"""{with_clause('seed_events')}, {_HALF}
select Seed_ID from half where Complete is null or trim(Complete) in ('', 'TBD') order by Seed_ID limit 10""",
        "reset": f"""{with_clause('seed_events')}, {_HALF},
marked as (select *, Complete is null or trim(Complete) in ('', 'TBD') as again from half)
select Seed_ID, {", ".join(f"case when again then 'TBD' else {c} end as {c}" for c in _COLUMNS)},
       Seed_Report_Redaction, Complete from marked""",
        "success_tally": f"""{with_clause('seed_events')}, {_EVENT_LOG}
select Seed_ID, WARCs, {", ".join(f"{_successes(c)} as {c}_Successes" for c in _WARC_COLUMNS)},
       {_ALL_SUCCESSFUL} as All_WARCs_Successful from log""",

        "audit": f"{with_clause('warc_listing', 'audit_log', 'stored_files')}, {_AUDIT} select * from audit",
        "audit_again": f"""{with_clause('warc_listing', 'audit_log', 'stored_files')}, {_AUDIT}
select * from audit union all by name select folder as seed_id, 'unexpected' as state from extras""",
        "extra_folders": f"""{with_clause('audit_log', 'stored_files')}
select distinct folder from stored_files where folder <> 'metadata.csv' and folder not in (select Seed_ID from audit_log)""",
        "audit_csv": f"""{with_clause('warc_listing', 'audit_log', 'stored_files')}, {_AUDIT}
select seed_id as "Seed", aip_id as "AIP", {", ".join(f'{_word(c)} as "{h}"' for h, c in _HEADERS)} from audit
union all
select folder, {", ".join(["'Not expected'"] * 10)} from extras""",
        "completeness_sink": f"""{with_clause('warc_listing', 'audit_log', 'stored_files')}, {_AUDIT}
select seed_id as "Seed", aip_id as "AIP", {", ".join(f'{_word(c)} as "{h}"' for h, c in _HEADERS)},
       row_number() over (order by o)::integer as line from (select audit.*, o from audit join tested using (seed_id))
union all
select folder, {", ".join(["'Not expected'"] * 10)}, ((select count(*) from audit) + row_number() over (order by folder))::integer from extras""",
        "qa_review": f"""{with_clause('warc_listing', 'audit_log', 'stored_files')}, {_AUDIT},
both_kinds as (select * from audit union all by name select folder as seed_id, 'unexpected' as state from extras),
logged as (select Seed_ID as seed_id, WARCs, Metadata_Report_Errors, Seed_Report_Redaction, AIP_ID as log_aip,
        {", ".join(_WARC_COLUMNS)}, string_split(Metadata_Report_Empty, '; ') as empties from audit_log),
ruled as (select b.seed_id, state, coalesce(folder_made, false) as folder_ok, coalesce(has_coll and has_seed, false) as reports_ok,
        coalesce(has_collscope or list_contains(empties, log_aip || '_collscope.csv'), false)
        and coalesce(has_seedscope or list_contains(empties, log_aip || '_seedscope.csv'), false) as scopes_ok,
        coalesce(warc_count_correct, false) as warc_count_ok, coalesce(file_types_expected, false) as file_types_ok,
        coalesce(Seed_Report_Redaction in ('Successfully redacted', 'No login columns to redact'), false) as redaction_ok,
        coalesce(Metadata_Report_Errors = 'Successfully downloaded all metadata reports', false) as report_errors_ok,
        coalesce(len(list_filter(empties, lambda e: not (e in (log_aip || '_collscope.csv', log_aip || '_seedscope.csv', 'No empty reports')))) = 0, false) as other_reports_ok,
        coalesce({_ALL_SUCCESSFUL}, false) as warc_messages_ok
        from both_kinds b left join logged l on l.seed_id = b.seed_id)
select * from (select *, folder_ok and reports_ok and scopes_ok and warc_count_ok and file_types_ok and redaction_ok
               and report_errors_ok and other_reports_ok and warc_messages_ok as passed from ruled) where not passed""",
    }
