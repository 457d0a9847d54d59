"""The registered queries of the operators, with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import bpe, decontaminate, grace, lm, packing, pii, quality, ranking, simhash, spelling, spotsigs, url_filter, warc
from tierwise.llm.common import documents
from tierwise.scratch import work_dir

BYTE_VOCABULARY = packing.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256)
Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the plain patterns', and all spans."""
    return pii.digests(pii.find(documents(spark, sf_dir)))


FETCHED = "timestamp_ntz '2023-01-01 00:00:00' + make_dt_interval(int(page_id * 7919 % 730), int(page_id % 24))"


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with the time they were fetched, which the table has not: spread over two years."""
    return documents(spark, sf_dir, "pages").selectExpr("page_id", "url", f"{FETCHED} AS fetched")


def dated_lists(pages: DataFrame) -> DataFrame:
    """Dated entries for the pages' hosts, parent domains and first path segments: which of them are
    listed, where, from when on and until when follows from their digests."""
    host = url_filter.host_of(F.col("url"))
    parent = F.regexp_extract(host, r"[^.]+\.[^.]+$", 0)
    first = F.concat(host, F.lit("/"), F.element_at(url_filter.segments_of(F.col("url")), 1))
    patterns = pages.select(F.explode(F.array(host, parent, first)).alias("pattern")).filter("pattern <> ''").distinct()
    digit = [F.conv(F.substring(F.md5("pattern"), at, 3), 16, 10).cast("int") for at in (1, 4, 7, 10)]
    begin = F.date_add(F.lit("2022-07-01").cast("date"), digit[1] % 800)
    name = F.element_at(F.array(F.lit("ads"), F.lit("fraud"), F.lit("malware")), digit[0] % 3 + 1)
    end, again = F.date_add(begin, digit[2] % 300), F.date_add(begin, digit[2] % 300 + digit[3] % 200)
    entry = [
        F.struct(begin.alias("day"), F.lit(True).alias("listed")),
        F.struct(end.alias("day"), F.lit(False).alias("listed")),
        F.struct(again.alias("day"), F.lit(True).alias("listed")),
    ]
    dated = F.explode(F.when(digit[0] % 2 == 0, F.array(*entry)).otherwise(F.array(entry[0])))
    return patterns.filter(digit[3] % 5 < 3).select(name.alias("list"), "pattern", dated.alias("e")).select("list", "pattern", "e.*")


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every capture with the lists that had it when it was fetched."""
    return url_filter.evaluate(captures(spark, sf_dir), dated_lists(documents(spark, sf_dir, "pages")))


SQL_LISTS = """with p as (select page_id, url, timestamp '2023-01-01' + to_days(cast(page_id * 7919 % 730 as int))
      + to_hours(cast(page_id % 24 as int)) fetched, lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url,
      '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\\.$', '')) host,
      [s for s in string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/') if s <> ''] segs
      from pages),
    names as (select distinct pattern from (select unnest([host, regexp_extract(host, '[^.]+\\.[^.]+$', 0),
      host || '/' || segs[1]]) pattern from p) where pattern <> ''),
    digits as (select pattern, [cast('0x' || substr(md5(pattern), i, 3) as int) for i in [1, 4, 7, 10]] d from names),
    begun as (select pattern, d, date '2022-07-01' + d[2] % 800 b, ['ads', 'fraud', 'malware'][d[1] % 3 + 1] list
      from digits where d[4] % 5 < 3),
    e as (select list, pattern, b as day, true listed from begun
      union all select list, pattern, b + d[3] % 300, false from begun where d[1] % 2 = 0
      union all select list, pattern, b + d[3] % 300 + d[4] % 200, true from begun where d[1] % 2 = 0),
    days as (select list, pattern, day, bool_and(listed) listed from e group by all),
    iv as (select *, coalesce(lead(day) over (partition by list, pattern order by day), date '9999-12-31') upto from days),
    m as (select p.page_id, p.url, p.fetched, iv.list from p join iv on iv.listed and iv.day <= cast(p.fetched as date)
      and cast(p.fetched as date) < iv.upto and (p.host = split_part(iv.pattern, '/', 1)
        or p.host like '%.' || split_part(iv.pattern, '/', 1))
      and (not contains(iv.pattern, '/') or p.segs[1] = split_part(iv.pattern, '/', 2)))
    select p.page_id, p.url, p.fetched, count(m.list) > 0 blocked, string_agg(distinct m.list, ',' order by m.list) lists,
      count(m.list) n_entries
    from p left join m on p.page_id = m.page_id group by p.page_id, p.url, p.fetched"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of ids and the digests of its ids and of their decoded text."""
    return bpe.encode(documents(spark, sf_dir), VOCABULARY, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, beside those of its edited text and of the next document."""
    return spotsigs.compare_with_next(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of 2,048 ids, read back from the files of their shards."""
    path = work_dir(spark, "packed")
    packing.write_packed(documents(spark, sf_dir), BYTE_VOCABULARY, path)
    return packing.read_packed(spark, path)


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-likelihood under the network trained on all of them."""
    return lm.score(documents(spark, sf_dir))


def good_and_bad() -> dict:
    """What the labels call good and bad; toxic documents of good quality are neither."""
    return {"good": (F.col("quality") == 1) & (F.col("toxic") == 0), "bad": F.col("quality") == 0}


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight, Gumbel key and whether it is in the sample."""
    found, _ = quality.resample(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), **good_and_bad())
    return found


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document has of the benchmark's windows of ten words."""
    return decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SQL_CONTAMINATION = f"""with d as (select doc_id, {SQL_WORDS} w from documents), b as (select item_id, {SQL_WORDS} w from benchmark),
    win as (select distinct item_id, n, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) win
      from (select *, least(10, len(w)) n from b) where n > 0),
    placed as (select doc_id, n, unnest(range(1, len(w) - n + 2)) i,
      unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) win
      from d join (select distinct n from win) on len(w) >= n),
    hit as (select doc_id, i, placed.n, item_id from placed join win using (win)),
    items as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) named
      from (select distinct doc_id, cast(item_id as varchar) item from hit) group by doc_id),
    inside as (select doc_id, count(distinct p) n_hit
      from (select doc_id, unnest(range(i, i + n)) p from (select distinct doc_id, i, n from hit)) group by doc_id)
    select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
      sha256(coalesce(named, '')) items_sha256, n_hit is not null contaminated
    from d left join items using (doc_id) left join inside using (doc_id)"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest id that links of two bits reach."""
    found = simhash.near_duplicates(documents(spark, sf_dir), words=3, seed=42, max_bits=2)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the WARC files that its ARC archives were converted to."""
    path = work_dir(spark, "warc")
    warc.write_warc(warc.with_revisits(warc.convert(warc.pages_as_arc(documents(spark, sf_dir, "pages")))), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_WARC = """select page_id, cast(bytes as bigint) payload_bytes, sha256(body) payload_digest,
    case when copy then 'revisit' else 'response' end record_type, case when copy then first end refers_to
  from (select *, bytes >= 100 and page_id <> first copy
    from (select page_id, body, strlen(body) bytes, min(page_id) over (partition by body) first
      from (select page_id, coalesce(html, '') body from pages)))"""


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every longer word of the documents with its most frequent near word and what that leads to."""
    return spelling.variants(documents(spark, sf_dir), least_length=7, least_count=2, ratio=10)


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each item of the benchmark."""
    return ranking.rank(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), k=10)


SQL_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SQL_RANKING = f"""with d as (select doc_id, {SQL_TERMS} w from documents),
    total as (select count(*) filter (len(w) > 0) big_n, cast(sum(len(w)) as bigint) big_l from d),
    q as (select item_id, term, count(*) times from (select item_id, unnest({SQL_TERMS}) term from benchmark) group by all),
    tf as (select doc_id, n, term, count(*) tf from (select doc_id, len(w) n, unnest(w) term from d) group by all),
    used as (select * from tf where term in (select term from q)),
    weight as (select term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) as bigint) w
      from used, total group by term, big_n),
    scored as (select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) as bigint) score
      from q join used using (term) join weight using (term), total group by item_id, doc_id),
    ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) r from scored where score > 0)
    select item_id, cast(r as int) rank, doc_id, score from ranked where r <= 10"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equals that is kept."""
    return grace.exact_duplicates(documents(spark, sf_dir))


SQL_EXACT = r"""select doc_id, min(doc_id) over same keep_id, count(*) over same group_size,
    doc_id = min(doc_id) over same kept, sha256(t) text_sha256
  from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents)
  window same as (partition by t)"""

QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_url_lists": op2_url_lists,
    "op3_bpe": op3_bpe,
    "op4_spotsigs": op4_spotsigs,
    "op5_packing": op5_packing,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_quality": op7_quality,
    "op8_decontamination": op8_decontamination,
    "op9_simhash": op9_simhash,
    "op10_warc": op10_warc,
    "op11_spelling": op11_spelling,
    "op12_ranking": op12_ranking,
    "op13_exact_dedup": op13_exact_dedup,
}
ORACLE: dict[str, str] = {
    "op2_url_lists": SQL_LISTS,
    "op8_decontamination": SQL_CONTAMINATION,
    "op10_warc": SQL_WARC,
    "op12_ranking": SQL_RANKING,
    "op13_exact_dedup": SQL_EXACT,
}
