"""DuckDB SQL for the views of ``sources.tables`` (the oracle side of every query).

Kept as plain text CTEs so that each oracle query reads the driver's tables directly.
"""

RAW_ENTRIES = """
raw_entries AS (
  SELECT 'loc/' || lang || '-' || lang || '/' || source || '.json.json' AS filepath,
         CAST(doc_id AS INTEGER) AS entry_idx,
         'k' || CAST(doc_id % 5 AS VARCHAR) AS string_key,
         CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS string_id,
         text AS female,
         CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN text || ' (m)' ELSE '   ' END AS male
  FROM documents
)"""

ENTRIES = """
entries AS (
  SELECT filepath, entry_idx, string_key, string_id, 0 AS variant_idx,
         'femaleVariant' AS field, female AS source_text
  FROM raw_entries WHERE trim(female) <> ''
  UNION ALL
  SELECT filepath, entry_idx, string_key, string_id, 1, 'maleVariant', male
  FROM raw_entries WHERE trim(male) <> ''
)"""

LOG = """
log AS (
  SELECT filepath, string_key, string_id, field, source_text,
         '[xx] ' || source_text AS translated_text, entry_idx, variant_idx
  FROM entries WHERE entry_idx % 5 = 0 AND variant_idx = 0
)"""

PENDING = """
pending AS (
  SELECT e.* FROM entries e
  WHERE NOT EXISTS (
    SELECT 1 FROM log l
    WHERE l.filepath = e.filepath AND l.string_key = e.string_key
      AND l.string_id IS NOT DISTINCT FROM e.string_id AND l.field = e.field)
)"""

GROUPS = """
groups AS (
  SELECT filepath, string_key, string_id,
         max_by(source_text, entry_idx) FILTER (WHERE field = 'femaleVariant') AS f_text,
         max(entry_idx) FILTER (WHERE field = 'femaleVariant') AS f_idx,
         max_by(source_text, entry_idx) FILTER (WHERE field = 'maleVariant') AS m_text,
         max(entry_idx) FILTER (WHERE field = 'maleVariant') AS m_idx,
         min(entry_idx) AS first_entry_idx
  FROM pending GROUP BY filepath, string_key, string_id
)"""

# units in translation order; is_dedup marks an identical pair sent once
UNITS = """
units AS (
  SELECT filepath, string_key, string_id, first_entry_idx, 0 AS variant_idx,
         'femaleVariant' AS field, f_idx AS entry_idx, f_text AS source_text,
         (m_idx IS NOT NULL AND f_text = m_text) AS is_dedup
  FROM groups WHERE f_idx IS NOT NULL
  UNION ALL
  SELECT filepath, string_key, string_id, first_entry_idx, 1, 'maleVariant', m_idx, m_text,
         FALSE
  FROM groups WHERE m_idx IS NOT NULL AND NOT (f_idx IS NOT NULL AND f_text = m_text)
)"""

NUMBERED = """
numbered AS (
  SELECT *, row_number() OVER (ORDER BY string_split(filepath, '/'), first_entry_idx,
                                        variant_idx) - 1 AS idx
  FROM units
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (RAW_ENTRIES, ENTRIES, LOG, PENDING, GROUPS)
