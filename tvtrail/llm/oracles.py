"""DuckDB SQL of the queries that SQL can state on whole tables in reasonable time."""

from tvtrail.llm.licenses import TEMPLATES

_BLANK = r"[^\x20\x09-\x0D]+"
_FOLDED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(text, '{pattern}'))"


QUALITY = rf"""WITH w AS (SELECT doc_id, coalesce(text,'') AS text, regexp_extract_all(coalesce(text,''), '{_BLANK}') AS words,
  [x for x in string_split(coalesce(text,''), chr(10)) if regexp_matches(x, '{_BLANK}')] AS lines FROM documents),
grams AS (SELECT doc_id, i, words[i:i+4] AS g FROM w, unnest(range(1, len(words)-3)) AS t(i)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g)>1),
covered AS (SELECT doc_id, count(DISTINCT i+k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY 1),
m AS (SELECT doc_id, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  len([i for i in range(2, len(words)+1) if words[i]=words[i-1]]) AS n_stutter, {_count('[#*$%&|<>]')} AS n_symbols, len(lines)-len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
  coalesce(covered.n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words<10 OR 100*n_repeat_words>20*n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10*n_symbols>n_words OR 2*n_dup_lines>n_lines OR word_chars>50*n_words OR 4*n_stutter>n_words
    OR {_count(r'\p{Lu}')}>{_count(r'\p{Ll}')} OR 4*{_count(r'\p{L}')}<word_chars) AS kept FROM f"""

CONTAMINATION = rf"""WITH iw AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_FOLDED}') AS words FROM benchmark),
iwin AS (SELECT DISTINCT item_id, k, words[i:i+k-1] AS g FROM (SELECT *, least(10, len(words)) AS k FROM iw WHERE len(words)>0),
  unnest(range(1, len(words)-k+2)) AS t(i)),
dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_FOLDED}') AS words FROM documents),
dwin AS (SELECT doc_id, k, i, words[i:i+k-1] AS g FROM dw, (SELECT DISTINCT k FROM iwin), unnest(range(1, len(words)-k+2)) AS t(i)),
hits AS (SELECT doc_id, i, dwin.k, item_id FROM dwin JOIN iwin ON iwin.k=dwin.k AND iwin.g=dwin.g),
h AS (SELECT doc_id, count(DISTINCT i+j) AS n_hit FROM hits, unnest(range(0, k)) AS r(j) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit,0) AS n_hit, coalesce(n_items,0) AS n_items,
  sha256(coalesce(listed,'')) AS items_sha256, coalesce(n_hit,0)>0 AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)"""

NEAR_DUPLICATES = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_BLANK}') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, words[i:i+4] AS g FROM w, unnest(range(1, len(words)-3)) AS t(i)
  UNION ALL SELECT doc_id, words FROM w WHERE len(words) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g=b.g AND a.doc_id<>b.doc_id GROUP BY 1,2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id=a JOIN n y ON y.doc_id=b WHERE 100*c >= 75*(x.n+y.n-c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a=r.b)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, a=min(b) AS kept
FROM reach LEFT JOIN n ON n.doc_id=a GROUP BY a"""

_CRC_STEPS = "list_reduce([{}, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384))"
_CRC_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))"
_CRC32 = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_CRC_BYTES}), lambda a, b: xor(a >> 8, {_CRC_STEPS.format('xor(a, b) & 255')})), 4294967295)"


def _told(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_told(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_SIBLINGS = "SELECT c.doc_id, c.lang, {next} AS level, c.i // 2 AS i, sha256(coalesce(l.h,'') || c.h || coalesce(r.h,'')) AS h, c.p || coalesce(l.h,'') || coalesce(r.h,'') AS p"

MANIFEST = f"""WITH RECURSIVE leaves AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
  {_leaf(f'n_chars + CASE WHEN {_CRC32} % 7 = 0 THEN 1 ELSE 0 END')} AS later,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents),
low AS (SELECT lang, 0 AS level, i, leaf AS h, n FROM leaves
  UNION ALL SELECT lang, level+1, i//2, sha256(string_agg(h, '' ORDER BY i)), any_value((n+1)//2) FROM low WHERE n>1 GROUP BY lang, level, i//2),
subs AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n=1),
high AS (SELECT 0 AS level, i, h, n FROM subs
  UNION ALL SELECT level+1, i//2, sha256(string_agg(h, '' ORDER BY i)), any_value((n+1)//2) FROM high WHERE n>1 GROUP BY level, i//2),
up AS (SELECT doc_id, lang, 0 AS level, i, later AS h, '' AS p FROM leaves
  UNION ALL {_SIBLINGS.format(next='c.level+1')}
  FROM up c JOIN low o ON o.lang IS NOT DISTINCT FROM c.lang AND o.level=c.level AND o.i=c.i AND o.n>1
  LEFT JOIN low l ON l.lang IS NOT DISTINCT FROM c.lang AND l.level=c.level AND l.i=c.i-1 AND c.i%2=1
  LEFT JOIN low r ON r.lang IS NOT DISTINCT FROM c.lang AND r.level=c.level AND r.i=c.i+1 AND c.i%2=0),
arrived AS (SELECT up.doc_id, up.lang, subs.i, up.h, up.p FROM up JOIN (SELECT doc_id, max(level) AS level FROM up GROUP BY 1) USING (doc_id, level)
  JOIN subs ON subs.lang IS NOT DISTINCT FROM up.lang),
over AS (SELECT doc_id, lang, 0 AS level, i, h, p FROM arrived
  UNION ALL {_SIBLINGS.format(next='c.level+1')}
  FROM over c JOIN high o ON o.level=c.level AND o.i=c.i AND o.n>1
  LEFT JOIN high l ON l.level=c.level AND l.i=c.i-1 AND c.i%2=1
  LEFT JOIN high r ON r.level=c.level AND r.i=c.i+1 AND c.i%2=0),
top AS (SELECT h AS root, level FROM high WHERE n=1)
SELECT doc_id, leaf, subs.h AS subroot, root, sha256(over.p) AS proof_sha256, over.h AS folded_root, over.h=root AS verified
FROM over JOIN top USING (level) JOIN leaves USING (doc_id) JOIN subs ON subs.lang IS NOT DISTINCT FROM leaves.lang"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(f"({n}, {_quoted(t.label)}, {_quoted(t.text)}, {t.exact})" for n, t in enumerate(TEMPLATES))

LICENSES = rf"""WITH t(template, label, text, exact) AS (VALUES {_TEMPLATES}),
tw AS (SELECT template, label, exact, regexp_extract_all({_LOWER}, '{_FOLDED}') AS w FROM t),
tg AS (SELECT template, label, exact, len(w) AS size, [k-1 for k in range(1, len(w)+1) if regexp_matches(w[k], '[0-9]')] AS versions, i-1 AS t_at, w[i:i+2] AS g FROM tw, unnest(range(1, len(w)-1)) AS u(i)),
dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_FOLDED}') AS w FROM documents),
votes AS (SELECT doc_id, template, label, exact, size, versions, p-t_at AS d, t_at
  FROM (SELECT doc_id, i-1 AS p, w[i:i+2] AS g FROM dw, unnest(range(1, len(w)-1)) AS u(i)) JOIN tg USING (g)),
diagonals AS (SELECT DISTINCT doc_id, template, exact, size, d FROM votes),
cuts AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, template ORDER BY d) <= CASE WHEN exact THEN 0 ELSE least(4, size//10*2) END THEN 0 ELSE 1 END AS cut FROM diagonals),
groups AS (SELECT doc_id, template, d, sum(cut) OVER (PARTITION BY doc_id, template ORDER BY d) AS grp FROM cuts),
spans AS (SELECT doc_id, template, any_value(label) AS label, any_value(exact) AS exact, any_value(size) AS size, any_value(versions) AS versions, list(t_at+k) AS places,
  min(d+t_at) AS a, max(d+t_at+3) AS b, count(DISTINCT t_at+k) AS covered
  FROM votes JOIN groups USING (doc_id, template, d), range(0, 3) AS r(k) GROUP BY doc_id, template, grp),
held AS (SELECT * FROM spans WHERE size-covered <= CASE WHEN exact THEN 0 ELSE size//10*2 END AND list_has_all(places, versions) AND b-a <= 2*size),
found AS (SELECT doc_id, count(*) FILTER (exact) AS n_base, min(a) FILTER (exact) AS first_word, max(a) FILTER (exact) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  max(covered/size) AS score FROM held GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM dw LEFT JOIN found USING (doc_id)"""
