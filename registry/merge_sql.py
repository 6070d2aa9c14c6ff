"""Oracle SQL for merges, written out clause by clause."""

from __future__ import annotations

from .base import NOW, OPEN


def digest(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"md5(concat_ws('|', {parts}))"


def match(keys: list[str], left: str, right: str, null_safe: bool = False, text: bool = False) -> str:
    sign = "IS NOT DISTINCT FROM" if null_safe else "="
    form = "lower({})" if text else "{}"
    return " AND ".join(f"{form.format(f'{left}.{k}')} {sign} {form.format(f'{right}.{k}')}" for k in keys)


def changed(columns: list[str], mode: str, null_safe: bool = False, texts: tuple[str, ...] = ()) -> str:
    if mode == "always":
        return "true"
    sign = "IS DISTINCT FROM" if null_safe else "<>"
    tests = []
    for c in columns:
        form = "lower({})" if c in texts else "{}"
        tests.append(f"{form.format('t.' + c)} {sign} {form.format('s.' + c)}")
    return "(" + (" AND " if mode == "all" else " OR ").join(tests) + ")"


def text_of(columns: list[str], stamps: list[str]) -> str:
    return ", ".join([*columns, *[f"CAST({c} AS VARCHAR) AS {c}" for c in stamps]])


STAMPS = ["EffectiveStartTime", "EffectiveEndTime", "CreatedDate", "ModifiedDate"]


def history(target: str, source: str, key: str, columns: list[str], tracked: list[str], surrogate: str,
            mode: str = "all", null_safe: bool = False, only_current: bool = True,
            first_start: str = NOW, stamp_new: bool = False, stamp_deleted: bool = False,
            undelete: bool = False, texts: tuple[str, ...] = (), text_key: bool = False,
            constants: dict[str, str] | None = None, parent: str | None = None,
            links: str | None = None, parent_id: str | None = None, tail: str | None = None) -> str:
    """Type-2 merge state. ``columns`` are business columns without key; ``links`` fills ``parent``."""
    constants = constants or {}
    own = [c for c in columns if c not in constants]
    fires = f"s.{key} IS NOT NULL AND {changed(tracked, mode, null_safe, texts)}"
    if only_current:
        fires += f" AND t.EffectiveEndTime = {OPEN} AND t.IsCurrent = 1"
    packed = ", ".join(f"s.{c} AS s_{c}" for c in [key, *own])
    modified = "fires OR gone" if stamp_deleted else "fires"
    back = "WHEN IsCurrent = 1 THEN 0 " if undelete else ""
    new_modified = NOW if stamp_new else "CAST(NULL AS TIMESTAMP)"
    every = [key, *columns]

    def new_rows(prefix: str, start: str, origin: str, nulls: tuple[str, ...] = ()) -> str:
        picks = []
        for c in every:
            if c in constants:
                picks.append(f"{constants[c]} AS {c}")
            elif c in nulls:
                picks.append(f"NULL AS {c}")
            else:
                picks.append(f"{prefix}{c} AS {c}")
        return (f"SELECT {', '.join(picks)}, 1 AS IsCurrent, {start} AS EffectiveStartTime, "
                f"{OPEN} AS EffectiveEndTime, 0 AS IsDeleted, {NOW} AS CreatedDate, "
                f"{new_modified} AS ModifiedDate FROM {origin}")

    audit = ["IsCurrent", "IsDeleted"]
    nulls = (parent,) if parent else ()
    body = f"""
WITH src AS ({source}),
joined AS (
  SELECT t.*, {packed}, coalesce({fires}, false) AS fires, s.{key} IS NULL AS gone
  FROM {target} t LEFT JOIN src s ON {match([key], 't', 's', text=text_key)}),
existing AS (
  SELECT {surrogate}, {', '.join(every)}, CASE WHEN fires THEN 0 ELSE IsCurrent END AS IsCurrent,
         EffectiveStartTime, CASE WHEN fires THEN {NOW} ELSE EffectiveEndTime END AS EffectiveEndTime,
         CASE WHEN gone THEN 1 {back}ELSE IsDeleted END AS IsDeleted, CreatedDate,
         CASE WHEN {modified} THEN {NOW} ELSE ModifiedDate END AS ModifiedDate FROM joined),
fresh AS (
  {new_rows('s_', NOW, 'joined WHERE fires')}
  UNION ALL
  {new_rows('s.', first_start, 'src s', nulls)}
  WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {match([key], 't', 's', text=text_key)})),
state AS (
  SELECT * FROM existing
  UNION ALL BY NAME
  SELECT (SELECT max({surrogate}) FROM {target}) + row_number() OVER (ORDER BY {digest([key])})
         AS {surrogate}, * FROM fresh)"""
    final = "state"
    if links:
        body += f""",
filled AS (
  SELECT d.* REPLACE (CASE WHEN d.IsCurrent = 1 AND d.{parent} IS NULL THEN p.{surrogate}
                           ELSE d.{parent} END AS {parent})
  FROM state d LEFT JOIN {links} l ON d.{key} = l.{key}
  LEFT JOIN state p ON l.{parent_id} = p.{key} AND p.IsCurrent = 1)"""
        final = "filled"
    if tail:
        return body + tail.format(final=final)
    return body + f"\nSELECT {text_of([surrogate, *every, *audit], STAMPS)} FROM {final}"


def upsert(target: str, source: str, keys: list[str], columns: list[str], update: list[str],
           mode: str = "any", surrogate: str | None = None, digest_columns: list[str] | None = None,
           null_safe_keys: bool = False, texts: tuple[str, ...] = (), text_key: bool = False,
           one_row: str = "src") -> str:
    """Type-1 merge state. ``columns`` include the keys; ``one_row`` names the source used for updates."""
    on = match(keys, "t", "s", null_safe_keys, text_key)
    fires = f"s.hit AND {changed(update, mode, texts=texts)}"
    picks = [f"CASE WHEN fires THEN s_{c} ELSE {c} END AS {c}" if c in update else c for c in columns]
    key_first = f"{surrogate}, " if surrogate else ""
    body = f"""
WITH src AS ({source}),
{one_row_sql(one_row, keys, columns, text_key)}
joined AS (
  SELECT t.*, {', '.join(f's.{c} AS s_{c}' for c in update)}, coalesce({fires}, false) AS fires
  FROM {target} t LEFT JOIN (SELECT *, true AS hit FROM {one_row}) s ON {on}),
existing AS (
  SELECT {key_first}{', '.join(picks)}, CreatedDate,
         CASE WHEN fires THEN {NOW} ELSE ModifiedDate END AS ModifiedDate FROM joined),
fresh AS (
  SELECT {', '.join(columns)}, {NOW} AS CreatedDate, {NOW} AS ModifiedDate FROM src s
  WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})),
state AS (SELECT * FROM existing UNION ALL BY NAME SELECT """
    if surrogate:
        body += (f"(SELECT max({surrogate}) FROM {target}) + row_number() OVER (ORDER BY "
                 f"{digest(digest_columns or keys)}) AS {surrogate}, ")
    body += "* FROM fresh)"
    shown = [surrogate, *columns] if surrogate else columns
    return body + f"\nSELECT {text_of(shown, ['CreatedDate', 'ModifiedDate'])} FROM state"


def one_row_sql(name: str, keys: list[str], columns: list[str], text_key: bool) -> str:
    """The smallest source row per key, NULL first, when a query picks one of several."""
    if name == "src":
        return ""
    form = "lower({})" if text_key else "{}"
    by = ", ".join(form.format(k) for k in keys)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return (f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {by} "
            f"ORDER BY {order}) AS rn FROM src) r WHERE rn = 1),")


def versions(target: str, source: str, key: str, value: str, columns: list[str],
             stamp_new: bool = True, only_open: bool = False, reopen: bool = False, text: bool = False) -> str:
    """Versioned-fact state; ``columns`` are the columns besides key, value and version dates."""
    form = "lower(coalesce({}, '-1'))" if text else "coalesce({}, -1)"
    own = [key, value, *columns]
    new_stamp = NOW if stamp_new else "CAST(NULL AS TIMESTAMP)"
    gone = "s.hit IS NULL AND t.EndDate IS NULL" if only_open else "s.hit IS NULL"
    known = f"{target} t WHERE t.EndDate IS NULL AND" if reopen else f"{target} t WHERE"
    return f"""
WITH src AS ({source}),
joined AS (
  SELECT t.*, {', '.join(f's.{c} AS s_{c}' for c in own)},
         coalesce(s.hit AND t.EndDate IS NULL AND {form.format('t.' + value)} <> {form.format('s.' + value)},
                  false) AS fires, {gone} AS gone
  FROM {target} t LEFT JOIN (SELECT *, true AS hit FROM src) s ON t.{key} = s.{key}),
state AS (
  SELECT {', '.join(own)}, StartDate, CASE WHEN fires OR gone THEN {NOW} ELSE EndDate END AS EndDate,
         CreatedDate, CASE WHEN fires OR gone THEN {NOW} ELSE ModifiedDate END AS ModifiedDate
  FROM joined
  UNION ALL
  SELECT {', '.join(f's_{c}' for c in own)}, {NOW}, NULL, {NOW}, NULL FROM joined WHERE fires
  UNION ALL
  SELECT {', '.join(own)}, {NOW}, NULL, {NOW}, {new_stamp} FROM src s
  WHERE {value} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {known} t.{key} = s.{key}))
SELECT {text_of(own, ['StartDate', 'EndDate', 'CreatedDate', 'ModifiedDate'])} FROM state"""
