"""Registered queries of this subpackage and, where it can be said, their SQL."""

from __future__ import annotations

from stratiform.llm import (
    bpe,
    conversation_repair,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language_id,
    packing,
    phrase_mining,
    quality_classifier,
    quality_rules,
    secret_scan,
    suffix_dedup,
    url_filters,
)
from stratiform.llm.common import read


def op1_html_extraction(spark, sf_dir):
    return html_extraction.extract(read(spark, sf_dir, "pages"))


def op2_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    found = language_id.language_id(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents")).drop("kept_text")


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents"))


def op6_bpe(spark, sf_dir):
    return bpe.bpe(read(spark, sf_dir, "documents"))


def op7_url_filters(spark, sf_dir):
    judged = url_filters.url_filter(read(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    rows = quality_rules.judged(quality_rules.ledger(read(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failures",
    )


def op10_quality_classifier(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_classifier.quality(docs, labels)


def op11_conversation_repair(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(rows))


def op12_phrase_mining(spark, sf_dir):
    return phrase_mining.mine(read(spark, sf_dir, "documents"))


def op13_secret_scan(spark, sf_dir):
    return secret_scan.report(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_bpe": op6_bpe,
    "op7_url_filters": op7_url_filters,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_secret_scan": op13_secret_scan,
}

_WS = r"[\x20\x09-\x0D]+"
_LEDGER = rf"""
    with docs as (
        select doc_id, coalesce(text, '') as t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
        from {{documents}}
    ), windows as (
        select doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) as win
        from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from docs)
    ), repeated as (
        select doc_id, i from windows
        qualify count(*) over (partition by doc_id, win) > 1
    ), covered as (
        select doc_id, count(distinct i + k) as n
        from repeated, (values (0), (1), (2)) as offsets(k) group by doc_id
    ), measured as (
        select docs.doc_id, t, cast(len(w) as bigint) as n_words,
               cast(length(regexp_replace(t, '{_WS}', '', 'g')) as bigint) as word_chars,
               cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
               cast(length(regexp_replace(t, '[^!]', '', 'g')) as bigint) as n_marks,
               cast(length(regexp_replace(t, '[^.。?…।۔]', '', 'g')) as bigint) as n_stops,
               cast(len(lines) as bigint) as n_lines,
               cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
               cast(coalesce(covered.n, 0) as bigint) as n_repeat_words
        from docs left join covered using (doc_id)
    ), ledger as (
        select *, {" + ".join(f"case when {r.sql} then {quality_rules.BIT[r.name]} else 0 end" for r in quality_rules.RULES)}
                  as failures
        from measured
    )
"""
_QUALITY = (
    _LEDGER
    + f"""
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
           (failures & {quality_rules.mask("v2")}) = 0 as kept,
           cast(failures as bigint) as failures
    from ledger
"""
)
_EXACT = rf"""
    select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = min(doc_id) over same as kept, sha256(plain) as text_sha256
    from (select doc_id, regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g') as plain
          from documents)
    window same as (partition by plain)
"""

# Repair: all paths row by row, the best of each state kept. ``moves`` are the insertions
# before a row and where they lead; the states are those of the operator.
_REPAIR = r"""
    with recursive crc_table as (
        select list_transform(range(0, 256), lambda n: list_reduce(
                   list_prepend(n, range(0, 8)),
                   lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end
               )) as t
    ), damaged as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(
                       string_split(concat_ws(':', coalesce(cast(conv_id as varchar), ' '),
                                              coalesce(cast(turn as varchar), ' ')), ''),
                       lambda x: cast(ord(x) as bigint))),
                   lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 20 as kind
        from conversations, crc_table
    ), present as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role,
               case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '')
                    else text end as text
        from damaged, unnest(range(0, case when kind = 0 then 0 when kind = 3 then 2 else 1 end))
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text)
                  as place,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
        from present
    ), seen as (
        select *, row_number() over (partition by conv_id, role, text order by place) > 1 as again,
               lag(role) over (partition by conv_id order by place) as before
        from placed
    ), found as (
        select *, body = '' as blank, body <> '' and again as duplicate,
               body <> '' and not again and right(body, 1) not in ('.', '!', '?') as truncated,
               before is not null
               and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au') as illegal
        from seen
    ), moves(state, inserted, next, rows) as (
        values (0, '', 0, []), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']),
               (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']),
               (2, '', 2, []), (2, 'I', 3, ['assistant:']), (3, '', 3, []), (3, 'I', 2, ['user:'])
    ), edits(state, edit, given, next) as (
        values (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3),
               (3, 'K', 'u', 2), (0, 'R', 'user', 2), (1, 'R', 'user', 2),
               (2, 'R', 'assistant', 3), (3, 'R', 'user', 2),
               (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3)
    ), paths as (
        select distinct conv_id, cast(0 as bigint) as place, 0 as state, cast(0 as bigint) as cost,
               '' as audit, cast([] as varchar[]) as kept
        from conversations
        union all
        select conv_id, place, state, cost, audit, kept from (
            select p.conv_id, r.place, e.next as state,
                   p.cost + 2 * length(m.inserted)
                   + case e.edit when 'D' then 3 when 'R' then 2 else 0 end
                   + case when r.truncated and e.edit <> 'D' then 1 else 0 end as cost,
                   p.audit || m.inserted || e.edit as audit,
                   list_concat(p.kept, m.rows, case e.edit
                       when 'D' then [] when 'K' then [r.role || ':' || r.text]
                       else [e.given || ':' || r.text] end) as kept
            from paths p
            join found r on r.conv_id is not distinct from p.conv_id and r.place = p.place + 1
            join moves m on m.state = p.state
            join edits e on e.state = m.next
             and (e.edit = 'D' or not (r.blank or r.duplicate))
             and (e.edit <> 'K' or left(r.role, 1) = e.given)
        ) qualify row_number() over (partition by conv_id, state order by cost, audit) = 1
    ), counts as (
        select conv_id, count(role) as n,
               coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count_if(blank) as blank, count_if(duplicate) as duplicate,
               count_if(truncated) as truncated, count_if(illegal) as illegal
        from (select distinct conv_id from conversations) as ids
        left join (select conv_id as c, * exclude (conv_id) from found) as f
          on c is not distinct from conv_id
        group by conv_id
    ), tails(state, inserted, rows) as (
        values (0, '', []), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])
    )
    select c.conv_id, cast(gaps as bigint) as gaps, cast(blank as bigint) as blank,
           cast(duplicate as bigint) as duplicate, cast(truncated as bigint) as truncated,
           cast(illegal as bigint) as illegal, p.cost + 2 * length(t.inserted) as cost,
           p.audit || t.inserted as audit,
           sha256(array_to_string(list_concat(p.kept, t.rows), chr(10))) as repaired_sha256
    from counts c
    join paths p on p.conv_id is not distinct from c.conv_id and p.place = c.n
    join tails t on t.state = p.state
    qualify row_number() over (
        partition by c.conv_id order by p.cost + 2 * length(t.inserted), p.audit || t.inserted) = 1
"""

_PHRASES = r"""
    with pieces as (
        select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
        from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
              from documents)
    ), places as (
        select lang, w, unnest(range(1, len(w) + 1)) as i from pieces
    ), f1 as (
        select lang, w[i] as p, count(*) as f from places group by all
    ), f2 as (
        select lang, w[i] as x, w[i + 1] as y, count(*) as f
        from places where i + 1 <= len(w) group by all
    ), f3 as (
        select lang, w[i] as x, w[i + 1] as y, w[i + 2] as z, count(*) as f
        from places where i + 2 <= len(w) group by all having count(*) >= 10
    ), pairs as (
        select lang, x, y, c.f as a, fx.f as l, fy.f as r,
               (1000000::hugeint * c.f * c.f) // (fx.f::hugeint * fy.f) as score
        from f2 c join f1 fx using (lang) join f1 fy using (lang)
        where fx.p = c.x and fy.p = c.y and c.f >= 10
    ), cuts as (
        select c.lang, c.x, c.y, c.z, c.f as a, fx.f as l1, yz.f as r1, xy.f as l2, fz.f as r2,
               (1000000::hugeint * c.f * c.f) // (fx.f::hugeint * yz.f) as s1,
               (1000000::hugeint * c.f * c.f) // (xy.f::hugeint * fz.f) as s2
        from f3 c
        join f1 fx on fx.lang = c.lang and fx.p = c.x
        join f1 fz on fz.lang = c.lang and fz.p = c.z
        join f2 xy on xy.lang = c.lang and xy.x = c.x and xy.y = c.y
        join f2 yz on yz.lang = c.lang and yz.x = c.y and yz.y = c.z
    ), around as (
        select lang, x, y, max(f) as longer
        from (select lang, x, y, f from f3 union all select lang, y, z, f from f3) group by all
    ), kept as (
        select lang, x || ' ' || y as phrase, a, l, r, score
        from pairs left join around using (lang, x, y)
        where longer is null or 100 * longer < 50 * a
        union all
        select lang, x || ' ' || y || ' ' || z, a, case when s1 <= s2 then l1 else l2 end,
               case when s1 <= s2 then r1 else r2 end, least(s1, s2)
        from cuts
    ), totals as (
        select lang, cast(sum(f) as bigint) as n from f1 group by lang
    )
    select lang, rank, phrase, a, l, r, n, score from (
        select lang, phrase, a, l, r, cast(score as bigint) as score,
               row_number() over (partition by lang order by score desc, a desc, phrase) as rank
        from kept) join totals using (lang)
    where rank <= 2000
"""

ORACLE_SQL = {
    "op12_phrase_mining": _PHRASES,
    "op11_conversation_repair": _REPAIR,
    "op8_exact_dedup": _EXACT,
    "op9_quality_rules": _QUALITY.format(documents="documents"),
}
