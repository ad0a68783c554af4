"""DuckDB SQL for the queries that SQL can express."""

from ledgerline.llm.chat_format import ChatTemplate
from ledgerline.llm.common import WORD
from ledgerline.llm.mixing import SEED
from ledgerline.llm.near_dup import PERCENT
from ledgerline.llm.weak_rules import (
    CAPITAL_WORD,
    KEEP_AT,
    PRIOR,
    RULES,
    START,
    STEPS,
    SYMBOL_WORD,
    SYMBOLS,
)

ORACLE_SQL = {}

ORACLE_SQL["op8_cover_tree_search"] = """
with v as (
    select vec_id, [cast(floor(64 * cast(x as double)) as double) for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""


def sql_text(value):
    return "'" + value.replace("'", "''") + "'"


def escaped_sql(column):
    out = f"replace({column}, '\\', '\\\\')"
    for control in ChatTemplate().controls:
        out = f"replace({out}, {sql_text(control)}, {sql_text(control[0] + chr(92) + control[1:])})"
    return out


def _op9():
    t = ChatTemplate()
    marks = len(t.role_open) + len(t.role_close) + len(t.turn_close)
    return f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), moves(state, role, next) as (
    values {", ".join(f"('{s}', '{r}', '{n}')" for (s, r), n in t.moves.items())}
), numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from turns
), walk as (
    select conv_id, i,
           case when i = 1 then 'start' else lag(role) over (partition by conv_id order by i) end as was, role,
           lead(i) over (partition by conv_id order by i) is null as last
    from numbered
), steps as (
    select conv_id,
           bool_and(case when i = 1 then role in ('system', 'user')
                         when was = 'system' then i = 2 and role = 'user'
                         when was = 'user' then role = 'assistant'
                         when was = 'assistant' then role = 'user'
                         else false end) and bool_or(last and role = 'assistant') as valid
    from walk group by conv_id
), digest as (
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
           coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '') as loss,
           {len(t.begin)} + sum({marks} + length({escaped_sql("role")}) + length({escaped_sql("text")})) as formatted_chars
    from numbered group by conv_id
)
select conv_id, n_turns, turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       cast(formatted_chars as bigint) as formatted_chars, valid
from digest join steps using (conv_id)
"""


ORACLE_SQL["op9_chat_format"] = _op9()


ORACLE_SQL["op7_temperature_mix"] = f"""
with rows as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {sql_text(WORD)})) as n_tokens from documents
), totals as (
    select source, sum(n_tokens)::bigint as tokens, count(*) as docs from rows group by source
), ends as (
    select max(tokens)::double as most, min(tokens)::double as least from totals where tokens > 0
), aim as (
    select most, case when most <= 2 * least then 0.0
        else least(1.0, greatest(0.0, ceil((1 - ln(2) / ln(most / least)) * 4294967296.0) / 4294967296.0)) end as a
    from ends
), power as (
    select totals.*, pow(tokens::double, a) as power, most, pow(most, a) as top from totals, aim where tokens > 0
), repeated as (
    select *, power / (sum(power) over ()) * (most * (sum(power) over ()) / top) / tokens as repeats from power
), budgets as (
    select source, tokens, docs, cast(floor(repeats + 1e-9) as bigint) as passes,
           greatest(cast(floor((repeats - floor(repeats + 1e-9)) * tokens) as bigint), 0) as rest,
           cast(ceil(sqrt(docs::double)) as bigint) as blocks
    from repeated
), uses as (
    select r.doc_id, r.source, r.n_tokens, passes, rest, blocks, unnest(range(0, coalesce(passes, 0) + 1)) as epoch
    from rows r left join budgets b on r.source is not distinct from b.source
), keyed as (
    select *, cast('0x' || substr(md5('{SEED}:' || epoch || ':' || coalesce(doc_id::varchar, '')), 1, 12) as bigint)
        as order_key
    from uses where passes is null or epoch < passes or rest > 0
), blocked as (
    select *, case when blocks > 0 then order_key % blocks end as block from keyed
), sizes as (
    select source, block, sum(n_tokens) as size from blocked where epoch = passes group by source, block
), befores as (
    select *, coalesce(sum(size) over (partition by source order by block rows between unbounded preceding
        and 1 preceding), 0) as before from sizes
), running as (
    select k.*, before, size, sum(n_tokens) over (partition by k.source, k.block order by order_key, doc_id nulls first) as running
    from blocked k join befores b on k.source is not distinct from b.source and k.block = b.block
    where epoch = passes
)
select doc_id, source, n_tokens, epoch, block, order_key from blocked where passes is null or epoch < passes
union all
select doc_id, source, n_tokens, epoch, block, order_key from running
where before < rest and (before + size <= rest or before + running <= rest)
"""


def _op3():
    votes = ", ".join(
        f"case when {bad} then -1 when {good} then 1 else 0 end as {rule}" for rule, (bad, good) in RULES.items()
    )
    names = ", ".join(RULES)
    share, g0, b0 = START
    odds = "ln(share / (1 - share))" + "".join(
        f" + case {r} when 1 then ln(g_{r}) - ln(1 - b_{r}) when -1 then ln(1 - g_{r}) - ln(b_{r}) else 0 end"
        for r in RULES
    )
    steps = ", ".join(
        f"(sum(n * p * ({r} = 1)::int) + {PRIOR} * sum(n) * {g0}) / (sum(n * p * ({r} <> 0)::int) + {PRIOR} * sum(n))"
        f", (sum(n * (1 - p) * ({r} = -1)::int) + {PRIOR} * sum(n) * {b0})"
        f" / (sum(n * (1 - p) * ({r} <> 0)::int) + {PRIOR} * sum(n))"
        for r in RULES
    )
    params = ", ".join(f"g_{r}, b_{r}" for r in RULES)
    start = ", ".join(f"{g0}::double, {b0}::double" for _ in RULES)
    return f"""
with recursive docs as materialized (
    select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), words as (
    select r, unnest(ws) as w, generate_subscripts(ws, 1) as i
    from (select r, regexp_extract_all(text, {sql_text(WORD)}) as ws from docs)
), windows as (
    select r, i, w, lead(w, 1) over (partition by r order by i) as w2, lead(w, 2) over (partition by r order by i) as w3
    from words
), twice as (
    select r, i from (select r, i, count(*) over (partition by r, w, w2, w3) as times from windows where w3 is not null)
    where times > 1
), repeats as (
    select r, count(distinct p) as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as p from twice) group by r
), counts as materialized (
    select r, doc_id, len(regexp_extract_all(text, {sql_text(WORD)})) as n_words,
           length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
           len(regexp_extract_all(text, {sql_text(SYMBOLS)})) as n_symbols,
           len([x for x in string_split(text, chr(10)) if regexp_matches(x, {sql_text(WORD)})]) as n_lines,
           len([x for x in string_split(text, chr(10)) if regexp_matches(x, {sql_text(WORD)})])
             - len(list_distinct([x for x in string_split(text, chr(10)) if regexp_matches(x, {sql_text(WORD)})])) as n_dup_lines,
           len(regexp_extract_all(text, '\\p{{Lu}}')) as n_capitals,
           len(regexp_extract_all(text, {sql_text(SYMBOL_WORD)})) as n_symbol_words,
           len(regexp_extract_all(text, {sql_text(CAPITAL_WORD)})) as n_capital_words,
           len(regexp_extract_all(text, '!')) as n_marks,
           coalesce(n_repeat_words, 0) as n_repeat_words
    from docs left join repeats using (r)
), voted as materialized (
    select *, {votes} from counts
), patterns as materialized (
    select {names}, count(*) as n from voted group by {names}
), em(step, share, {params}) as (
    select 0, {share}::double, {start}
    union all
    select step + 1, (sum(n * p) + {PRIOR} * sum(n) * {share}) / (sum(n) + {PRIOR} * sum(n)), {steps}
    from (select step, n, {names}, 1 / (1 + exp(-({odds}))) as p from em, patterns where step < {STEPS})
    group by step
), judged as (
    select voted.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
           1 / (1 + exp(-({odds}))) as posterior
    from voted, (select * from em where step = {STEPS})
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and posterior >= {KEEP_AT} as kept
from judged
"""


ORACLE_SQL["op3_quality_rules"] = _op3()


def near_dup_sql(table, k, percent=PERCENT):
    """Exact links from shared shingles, then the smallest reachable id."""
    row = ", ".join(["w"] + [f"lead(w, {i}) over (partition by doc_id order by i)" for i in range(1, k)])
    return f"""
with recursive words as (
    select doc_id, ws, unnest(ws) as w, generate_subscripts(ws, 1) as i from (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), {sql_text(WORD)}) as ws
        from {table} where doc_id is not null)
), runs as (
    select doc_id, len(ws) as size, i, [{row}] as s from words
), shingles as materialized (
    select distinct doc_id, md5(array_to_string(s, ' ')) as s from runs where i <= greatest(size - {k} + 1, 1)
), sizes as materialized (
    select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as i
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all
), links as materialized (
    select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * i >= {percent} * (p.n + q.n - i)
), reach(doc_id, other) as (
    select a, b from links union select reach.doc_id, links.b from reach join links on reach.other = links.a
), least_of as (
    select doc_id, least(doc_id, min(other)) as component_id from reach group by doc_id
)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id,
       d.doc_id = coalesce(component_id, d.doc_id) as kept
from (select distinct doc_id from {table} where doc_id is not null) d
left join sizes using (doc_id) left join least_of using (doc_id)
"""


ORACLE_SQL["op6_minhash_near_dup"] = near_dup_sql("documents", 4)


def _vector_codes_sql(rounds=6, parts=8, entries=16) -> str:
    """Lloyd rounds written out; every round compares every part with all entries of its codebook."""
    steps = [
        """kept as materialized (
  select vec_id, label, row_number() over (order by vec_id, v) as row_no, v, len(v) // {parts} as width
  from (select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
        from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0))""",
        """cells as materialized (
  select row_no, label, vec_id, p, v[p * width + 1 : (p + 1) * width] as x from kept, range({parts}) as r(p))""",
        "book0 as materialized (select p, row_no - 1 as entry, x as c from cells where row_no <= {entries})",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""met{i} as materialized (
  select row_no, vec_id, label, p, min(struct_pack(d := d, e := entry)) as best
  from (select cells.*, entry,
               list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from cells join book{i} using (p)) group by all)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} as materialized (
  select p, entry, coalesce(moved.c, book{i}.c) as c
  from book{i} left join (
    select p, entry, list((s - ((s % n) + n) % n) // n order by pos)::bigint[] as c
    from (select p, best.e as entry, pos, sum(x[pos])::bigint as s, count(*) as n
          from met{i} join cells using (row_no, p), range(1, 1 + (select max(width) from kept)) as g(pos)
          group by all) group by all) as moved using (p, entry))"""
            )
    steps.append(
        f"""found as (
  select vec_id, label, row_no, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error
  from met{rounds} group by all)"""
    )
    steps.append(f"""books as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, entry)) as codebooks_sha256 from book{rounds})""")
    return (
        "with " + ",\n".join(steps).replace("{parts}", str(parts)).replace("{entries}", str(entries)) + """
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from found, books"""
    )


ORACLE_SQL["op13_vector_codes"] = _vector_codes_sql()
