"""SQL that must give the same rows as the queries."""

URL_FILTER = r"""
with parts as (
  select page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
counted as (
  select host, count(quality) as n, coalesce(sum(quality), 0)::bigint as good,
         string_split(regexp_replace(host, ':[0-9]*$', ''), '.') as pieces,
         regexp_matches(host, '^([0-9.]+(:[0-9]*)?$|\[)') as number,
         array_to_string(list_slice(pieces, -2, -1), '.') in (
           'ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.za', 'co.jp', 'co.kr', 'co.in',
           'com.br', 'com.cn', 'com.mx', 'com.tr', 'com.tw', 'github.io', 'gitlab.io', 'blogspot.com', 'wordpress.com') as shared
  from parts left join labels on doc_id = page_id group by host),
hosts as (
  select host, n, good,
         array_to_string(case when number then pieces else list_slice(pieces, if(shared, -3, -2), -1) end, '.') as domain,
         array_to_string(case when number then pieces else list_slice(pieces, if(shared, -2, -1), -1) end, '.') as suffix
  from counted),
top as (select (sum(good) + 1) / (sum(n) + 2) as m, (sum(n) + 2)::double as p from hosts),
suffix_n as (select suffix, sum(n) as n, sum(good) as good, m, p from hosts, top group by suffix, m, p),
suffix_w as (
  select 1 / (least(greatest(coalesce(sum((good - n * m) ** 2 / n - m * (1 - m))
    / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.02), 0.02), 0.5)) - 1 as k from suffix_n where n > 0),
suffix_m as (
  select suffix, (good + 1 / (1 / k + 1 / p) * m) / (n + 1 / (1 / k + 1 / p)) as m, n + 1 / (1 / k + 1 / p) as p
  from suffix_n, suffix_w),
domain_n as (
  select domain, suffix, m, p, sum(n) as n, sum(good) as good
  from hosts join suffix_m using (suffix) group by all),
domain_w as (
  select 1 / (least(greatest(coalesce(sum((good - n * m) ** 2 / n - m * (1 - m))
    / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.02), 0.02), 0.5)) - 1 as k from domain_n where n > 0),
domain_m as (
  select domain, (good + 1 / (1 / k + 1 / p) * m) / (n + 1 / (1 / k + 1 / p)) as m, n + 1 / (1 / k + 1 / p) as p
  from domain_n, domain_w),
host_n as (select hosts.*, m, p from hosts join domain_m using (domain)),
host_w as (
  select 1 / (least(greatest(coalesce(sum((good - n * m) ** 2 / n - m * (1 - m))
    / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.02), 0.02), 0.5)) - 1 as k from host_n where n > 0),
ab as (
  select host, good + 1 / (1 / k + 1 / p) * m as a, n - good + 1 / (1 / k + 1 / p) * (1 - m) as b from host_n, host_w),
bounds as (
  select host, a / (a + b) as share, 1 / (1 + exp(-(ln(a / b) + 1.64 * sqrt(1 / a + 1 / b)))) as bound from ab),
ruled as (
  select *,
    case when (host = 'www.example.com' or suffix(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
         when (host = 'example.com' or suffix(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
         when (host = 'net' or suffix(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
         when (host = 'net' or suffix(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
         when (host = 'com' or suffix(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from parts)
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
            when bound < 0.5 then 'block' else 'allow' end as verdict, round(share, 9) as share, round(bound, 9) as bound
from ruled join bounds using (host)
"""

MIX_SOURCES = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as digest
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from sized group by source),
steps as (
  -- Sources in the order in which they reach their limit: the rate if all before them are held.
  select *, (1.5 * sum(source_size) over () - coalesce(sum(2 * source_size) over before, 0))
            / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as rate
  from sources
  window before as (order by 2 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
final as (select max(rate) as rate from steps where weight * rate <= 2 * source_size),
shares as (
  select source, source_size, least(weight * rate, 2.0 * source_size)::double as target,
         case weight when 5 then -0.5 when 2 then 0.0 else 0.5 end::double as ramp
  from sources, final),
placed as (
  select s.doc_id, size, source_size, target, ramp,
         case when source_size > 0 then floor(target / source_size)::bigint else 0 end as times,
         coalesce(sum(size) over (partition by s.source order by digest, s.doc_id, size
           rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sized s join shares t on s.source is not distinct from t.source),
counted as (
  select *, greatest(0, least(size, round(target)::bigint - times * source_size - start)) as more from placed),
demanded as (
  select *, case when times > 0 or more > 0 then
         least(1.0::double, case when target > 0 then start::double / target else 0.0::double end) end as demand
  from counted)
select doc_id, size, source_size, target, (times * size + more)::bigint as taken,
       (times + (more > 0)::bigint)::bigint as n_copies,
       case when demand is null then null
            when 1 - ramp + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * demand) > 0
            then 2 * demand / (1 - ramp + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * demand)) else 0.0 end as position
from demanded
"""

# CRC-32, byte by byte, of the column ``bytes`` (hexadecimal) of the rows of a table ``keyed``.
_CHECKSUM = r"""
crc as (
  select list(list_reduce(list_prepend(i, range(8)),
           lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as entries
  from range(256) as t(i)),
summed as (
  select keyed.*, xor(4294967295, list_reduce(
           list_prepend(4294967295::bigint, list_transform(range(1, length(bytes), 2),
             lambda i: 16 * (instr('0123456789ABCDEF', bytes[i]) - 1) + instr('0123456789ABCDEF', bytes[i + 1]) - 1)),
           lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) as checksum
  from keyed, crc)"""

SPELLING_VARIANTS = (
    r"""
with recursive found as (
  select coalesce(doc_id::varchar, '') as id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
keyed as (select id, run, count(*) as times, hex(encode(id || ':' || run)) as bytes from found group by id, run),"""
    + _CHECKSUM
    + r""",
typed as (
  select times, case when checksum % 97 <> 0 then run
    else run[:checksum % length(run)] || run[checksum % length(run) + 2:] end as word
  from summed),
words as (
  select word, sum(times)::bigint as n from typed where length(word) >= 5 group by word having sum(times) >= 3),
gaps as (select word, i, word[:i - 1] || word[i + 1:] as gap from words, lateral (select unnest(range(1, length(word) + 1)) as i)),
near as (
  select a.word, b.word as near from gaps a join gaps b on a.gap = b.gap and a.i = b.i and a.word <> b.word
  union select word, gap from gaps where gap in (select word from words)
  union select gap, word from gaps where gap in (select word from words)),
best as (
  select near.word, count(*) as n_near, min((-w.n, near.near)) as best
  from near join words w on w.word = near.near group by near.word),
forms as (
  select words.word, n, coalesce(n_near, 0)::bigint as n_near,
         case when -best[1] >= 2 * n then best[2] end as form, case when -best[1] >= 2 * n then -best[1] end as form_n
  from words left join best using (word)),
chains as (
  select word, word as reached from forms
  union all
  select chains.word, form from chains join forms on forms.word = reached where form is not null)
select forms.word, forms.form, reached as root, forms.n, forms.n_near, forms.form_n::bigint as form_n
from chains join forms ends on ends.word = reached and ends.form is null join forms on forms.word = chains.word
"""
)

IMPORTANCE_RESAMPLING = (
    r"""
with texts as (
  select doc_id, row_number() over () as line, true as own, text from documents
  union all select null, null, false, text from benchmark),
found as (
  select own, line, unnest(regexp_extract_all(translate(text,
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from texts),
counted as (select own, line, word, count(*) as n from found group by all),
keyed as (select distinct word, hex(encode(word)) as bytes from counted),"""
    + _CHECKSUM
    + r""",
features as (select own, line, checksum % 10000 as bucket, n from counted join summed using (word)),
totals as (
  select coalesce(sum(n) filter (own), 0)::double as s_all, coalesce(sum(n) filter (not own), 0)::double as t_all from features),
gains as (
  select bucket, floor(1000 * ln((coalesce(sum(n) filter (not own), 0) + 1.0::double) * (s_all + 10000)
         / ((coalesce(sum(n) filter (own), 0) + 1.0::double) * (t_all + 10000))))::bigint as gain
  from features, totals group by bucket, s_all, t_all),
weights as (select line, sum(n) as n_features, sum(n * gain) as weight from features join gains using (bucket) where own group by line),
scored as (
  select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::varchar, ''))[:8])::bigint + 0.5::double)
           / 4294967296)))::bigint as score
  from texts left join weights using (line) where own),
drawn as (
  select *, n_features >= 20 as long, row_number() over (partition by n_features >= 20
         order by score desc, doc_id nulls last, weight, n_features) as place, count(*) over (partition by n_features >= 20) as n
  from scored)
select doc_id, n_features, weight, score, case when long and place <= 10 * n // 100 then place end as rank from drawn
"""
)

JACCARD_JOIN = r"""
with recursive spoken as (
  select row_number() over () as line, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) as words
  from documents),
sets as (
  select line, doc_id, list_sort(list_distinct(case
           when len(words) >= 5 then list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
           when len(words) > 0 then [array_to_string(words, ' ')] else [] end)) as shingles
  from spoken),
kinds as (select row_number() over () as kind, shingles, len(shingles) as n, min(doc_id) as first from sets where len(shingles) > 0 group by shingles),
parts as (select kind, unnest(shingles) as shingle from kinds),
common as (select a.kind as a, b.kind as b, count(*) as n from parts a join parts b on a.shingle = b.shingle and a.kind < b.kind group by all),
links as (
  select a, b from common join kinds k on k.kind = a join kinds l on l.kind = b
  where 100 * common.n >= 80 * (k.n + l.n - common.n)),
ends as (select a, b from links union select b, a from links),
reached as (
  select kind, kind as other from kinds
  union select reached.kind, b from reached join ends on a = other),
least as (select reached.kind, min(first) as component_id from reached join kinds on kinds.kind = other group by reached.kind)
select doc_id, len(sets.shingles)::bigint as n_shingles, case when len(sets.shingles) > 0 then component_id else doc_id end as component_id
from sets left join kinds on kinds.shingles = sets.shingles left join least using (kind)
"""
