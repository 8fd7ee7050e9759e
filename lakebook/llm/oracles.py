"""DuckDB SQL of the corpus queries that SQL can express.

No such SQL exists for token ids, hashes with a seed, CRC-32, trees or alignments; those
queries are compared with brute force in the tests.
"""

from __future__ import annotations

from .chat import Template
from .quality import LEAST_WORDS, MOST_REPEATED_PERCENT, RULES, STOP_WORDS, SYMBOLS, WINDOW
from .substrings import WINDOW as REPEAT

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"
WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{SPACES}'), lambda x: x <> '')"


def url_sql(rules: dict[str, str]) -> str:
    listed = ", ".join(
        f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in rules.items()
    )
    return f"""
with rules(rule, rule_host, rule_path, verdict) as (values {listed}),
cut as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
  from pages
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from cut left join rules
  on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
qualify row_number() over (partition by page_id order by length(rule) desc nulls last) = 1
"""


def quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    metrics = {
        "mean_word_chars": ("word_chars", "n_words"),
        "symbols_per_word": ("n_symbols", "n_words"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "capital_ratio": ("n_capitals", "n_letters"),
    }

    def tests():
        for rule in RULES:
            a, b = metrics[rule.metric]
            value = f"(case when {b} > 0 then {a}::double / {b} else 0 end)"
            if rule.least is not None:
                yield f"{value} >= {rule.least}"
            if rule.most is not None:
                yield f"{value} <= {rule.most}"

    return rf"""
with base as (
  select doc_id, coalesce(text, '') as t, {WORDS} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
),
starts as (
  select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as pos
  from base where len(words) >= {WINDOW}
),
windows as (
  select doc_id, pos, count(*) over (partition by doc_id, array_to_string(words[pos:pos + {WINDOW - 1}], ' ')) as n
  from starts
),
repeated as (
  select doc_id, count(distinct pos + k) as n_repeat_words
  from windows, (select unnest(range({WINDOW})) as k) where n > 1 group by doc_id
),
counted as (
  select doc_id, len(words) as n_words,
    length(regexp_replace(t, '{SPACES}', '', 'g')) as word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    len(lines) as n_lines,
    len(list_filter(words, lambda x: lower(x) in ({stop}))) as n_stop_words,
    length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g')) as n_letters,
    length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) as n_capitals
  from base left join repeated using (doc_id)
),
judged as (
  select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words as base_failed
  from counted
)
select *, not base_failed and {" and ".join(tests())} as kept from judged
"""


def chat_sql(probe: str, template: Template = Template()) -> str:
    controls = "|".join(
        "".join(f"\\{c}" if c in "[]|/<>" else c for c in s) for s in template.controls()
    )
    fixed = len(template.turn) + len(template.text) + len(template.end)

    def escaped(column: str) -> str:
        return rf"length(regexp_replace(replace({column}, '\', '\\'), '({controls})', '\1~', 'g'))"

    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, i, case when i = 0 then 'user' else 'assistant' end, '{probe}' from range(2) t(i)
),
placed as (
  select *, {fixed} + {escaped("role")} + {escaped("text")} as chars,
    row_number() over w as place, count(*) over (partition by conv_id) as turns
  from turns window w as (partition by conv_id order by turn nulls first, role, text)
),
summed as (
  select *, sum(chars) over (partition by conv_id order by place) as so_far,
    role = 'assistant' or place = turns as shown
  from placed
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(so_far) filter (shown))::bigint as formatted_chars,
  count(*) filter (shown) as n_examples
from summed group by conv_id
"""


def substring_sql() -> str:
    return f"""
with base as (select doc_id, {WORDS} as words from documents),
starts as (
  select doc_id, words, unnest(range(1, len(words) - {REPEAT - 2})) as pos
  from base where len(words) >= {REPEAT}
),
owned as (
  select doc_id, pos,
    min(doc_id) over (partition by array_to_string(words[pos:pos + {REPEAT - 1}], ' ')) as owner
  from starts
),
gone as (
  select distinct doc_id, pos + k as pos
  from owned, (select unnest(range({REPEAT})) as k) where owner < doc_id
),
words as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from base),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as text
  from words anti join gone using (doc_id, pos) group by doc_id
)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from base left join kept using (doc_id)
"""


def exact_sql() -> str:
    return """
        with texts as (select doc_id, coalesce(text, '') as text from documents)
        select
            doc_id,
            max(doc_id) over same as keep_id,
            count(*) over same as group_size,
            doc_id = max(doc_id) over same as kept,
            sha256(text) as text_sha256
        from texts
        window same as (partition by text)
    """
