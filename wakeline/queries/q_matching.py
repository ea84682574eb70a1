"""Identity, flag, port and zone matching, and the classification built on them."""

from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import identity
from wakeline.operators import classify as cl
from wakeline.operators import graph, matching, merge
from wakeline.queries import fragments as S
from wakeline.queries.q_filters import PORT_TERMS, port_ctes
from wakeline.queries.registry import query

# --- SQL building blocks --------------------------------------------------------------
WATCH = ", ".join(f"""w_{k} AS (SELECT {e} AS id, max(line_no) AS line_no FROM v_watchlist WHERE {e} IS NOT NULL GROUP BY 1)"""
                  for k, e in (("imo", S.digits("imo")), ("mmsi", S.digits("mmsi")), ("callsign", S.norm_text("callsign"))))
MATCHED = WATCH + f""", matched AS (SELECT c.*, CASE WHEN i.id IS NOT NULL THEN 'imo' WHEN m.id IS NOT NULL THEN 'mmsi'
 WHEN s.id IS NOT NULL THEN 'callsign' END AS matched_on, coalesce(i.line_no, m.line_no, s.line_no) AS watch_line
FROM v_contacts c LEFT JOIN w_imo i ON {S.digits('c.imo')} = i.id LEFT JOIN w_mmsi m ON {S.digits('c.mmsi')} = m.id
LEFT JOIN w_callsign s ON {S.norm_text('c.callsign')} = s.id)"""
FLAG_ROWS = f"""f AS (SELECT *, {S.norm_key('state_name')} AS nk FROM v_flags WHERE active <> 'no')"""
MIDS = FLAG_ROWS + """, mids AS (SELECT mid, arg_min(state_name, pref) AS state_name FROM (
 SELECT substr(regexp_replace(m, '[^0-9]', '', 'g'), 1, 3) AS mid, arg_max(state_name, line_no) AS state_name, 0 AS pref FROM (
  SELECT unnest(string_split_regex(mmsi_mid_prefixes, '[;,|]')) AS m, state_name, line_no FROM f) GROUP BY 1
 UNION ALL SELECT mid, state_name, 1 FROM (VALUES """ + ", ".join(f"('{m}', '{n}')" for m, n in P.MID_FLAGS.items()) + """) v(mid, state_name)) GROUP BY 1)"""
FLAGGED = MIDS + f""", flagged AS (SELECT c.event_id, CASE WHEN {S.present('c.flag')} IS NOT NULL THEN coalesce(n.state_name, i.state_name, {S.present('c.flag')})
  ELSE mids.state_name END AS flag_detected,
 CASE WHEN n.state_name IS NOT NULL THEN 'explicit_flag' WHEN i.state_name IS NOT NULL THEN 'explicit_iso' WHEN {S.present('c.flag')} IS NOT NULL
  THEN 'explicit_flag' WHEN mids.state_name IS NOT NULL THEN 'mmsi_mid:' || mids.mid END AS flag_source
FROM v_contacts c LEFT JOIN f n ON {S.norm_key('c.flag')} = n.nk LEFT JOIN f i ON {S.norm_text('c.flag')} = i.iso_code
LEFT JOIN mids ON {S.present('c.flag')} IS NULL AND substr(c.mmsi, 1, 3) = mids.mid)"""
RISK = FLAGGED + f""", risk AS (SELECT flagged.*, upper(coalesce(n.risk_category, i.risk_category)) AS cat, coalesce(n.registry_status, i.registry_status) AS status
FROM flagged LEFT JOIN f n ON {S.norm_key('flag_detected')} = n.nk LEFT JOIN f i ON {S.norm_text('flag_detected')} = i.iso_code),
banded AS (SELECT *, CASE WHEN cat IS NULL THEN NULL WHEN cat = 'A' OR status IN ({S.quoted(P.HARD_REGISTRY_STATUSES)}) THEN 'hard'
 WHEN cat = 'C' OR status IN ({S.quoted(P.CONTEXT_REGISTRY_STATUSES)}) THEN 'context' ELSE 'soft' END AS band,
 CASE cat WHEN 'A' THEN 90 WHEN 'B' THEN 70 WHEN 'C' THEN 45 END AS score FROM risk)"""
ZONES = f"""zones AS (SELECT event_id, z.id AS zone_id FROM v_contacts, (VALUES {S.ZONE_VALUES}) z(id, s, n, w, e)
 WHERE latitude BETWEEN s AND n AND longitude BETWEEN w AND e)"""
CLASSIFIED = f"""{MATCHED}, {RISK}, {PORT_TERMS}, {port_ctes('d', 'destination')}, {port_ctes('p', 'last_port')}, {ZONES},
facts AS (SELECT m.*, coalesce(d.matched, false) AS declared, coalesce(p.matched, false) AS confirmed, b.band, b.status,
 coalesce(w.track_sanctions, false) AS t_s, coalesce(w.track_shadowfleet, false) AS t_f, coalesce(w.track_falseflag, false) AS t_ff, coalesce(w.track_behavior, false) AS t_b,
 {S.TANKER} AS tanker, {S.GATEWAY} AS area, {S.present('m.imo')} IS NULL AS missing_imo,
 (SELECT count(*) FROM zones z WHERE z.event_id = m.event_id) AS n_zones
 FROM matched m LEFT JOIN v_watchlist w ON w.line_no = m.watch_line LEFT JOIN banded b ON b.event_id = m.event_id
 LEFT JOIN d ON d.text = m.destination LEFT JOIN p ON p.text = m.last_port),
reasoned AS (SELECT *, coalesce(band = 'hard' OR status IN ({S.quoted(P.HARD_REGISTRY_STATUSES)}), false) AS r_hard,
 (CAST(t_s OR t_f AS INT) + CAST(t_ff AS INT) + CAST(confirmed AS INT) + CAST(area AS INT) + CAST(missing_imo AS INT)) AS others FROM facts),
flags2 AS (SELECT *, t_ff OR (r_hard AND others >= 1) AS hard_watch, coalesce(band <> 'context', false) AS soft FROM reasoned),
found AS (SELECT *, list_sort([x FOR x IN [CASE WHEN mmsi LIKE '273%' THEN 'russian_mmsi' END, CASE WHEN confirmed THEN 'recent_russian_portcall_10d' END,
 CASE WHEN soft OR t_ff THEN 'falseflag_interest' END, CASE WHEN hard_watch AND (band IS NOT NULL OR matched_on IS NOT NULL) THEN 'false_flag_watch' END,
 CASE WHEN matched_on IS NOT NULL THEN 'watchlist' END, CASE WHEN t_s OR t_f THEN 'sanctions_shadowfleet' END, CASE WHEN t_b THEN 'behavioral_voi' END]
 IF x IS NOT NULL]) AS found FROM flags2),
classified AS (SELECT *, CASE WHEN tanker AND n_zones > 0 AND len(found) = 0 AND NOT declared THEN ['neutral_tanker_context'] ELSE found END AS categories FROM found)"""


def classified(t):
    return cl.classify(t.contacts, t.watchlist, matching.port_terms(t.ports), t.flags)


# --- joins ---------------------------------------------------------------------------

@query("jn01_watchlist_cascade", f"WITH {MATCHED} SELECT event_id, matched_on, watch_line FROM matched")
def _(t):
    return matching.match_watchlist(t.contacts, t.watchlist).select(
        "event_id", "matched_on", F.col("watch_line_no").alias("watch_line"))


_CATS = f"""list_sort([x FOR x IN ['watchlist', CASE WHEN track_sanctions OR track_shadowfleet THEN 'sanctions_shadowfleet' END,
 CASE WHEN track_falseflag THEN 'falseflag_interest' END, CASE WHEN track_behavior THEN 'behavioral_voi' END,
 CASE WHEN {S.digits('mmsi')} LIKE '273%' THEN 'russian_mmsi' END] IF x IS NOT NULL])"""
_KNOWN = f"""src AS (SELECT *, {_CATS} AS cats FROM v_watchlist),
idx AS (SELECT kind, id, list_sort(list_distinct(flatten(list(cats)))) AS cats FROM (SELECT 'imo' AS kind, {S.digits('imo')} AS id, cats FROM src
 UNION ALL SELECT 'mmsi', {S.digits('mmsi')}, cats FROM src UNION ALL SELECT 'callsign', {S.norm_text('callsign')}, cats FROM src) WHERE id IS NOT NULL GROUP BY ALL),
nm AS (SELECT {S.norm_key('name')} AS nk, list_sort(list_distinct(flatten(list(cats)))) AS cats FROM src WHERE {S.norm_key('name')} IS NOT NULL GROUP BY 1
 HAVING count(DISTINCT coalesce({S.digits('imo')}, {S.digits('mmsi')}, {S.norm_text('callsign')}, {S.norm_key('name')})) = 1)"""


@query("jn02_known_categories", f"""
WITH {_KNOWN}, e AS (SELECT c.*, i.cats AS ic, m.cats AS mc, s.cats AS sc FROM v_contacts c
 LEFT JOIN idx i ON i.kind = 'imo' AND i.id = {S.digits('c.imo')} LEFT JOIN idx m ON m.kind = 'mmsi' AND m.id = {S.digits('c.mmsi')}
 LEFT JOIN idx s ON s.kind = 'callsign' AND s.id = {S.norm_text('c.callsign')}),
n AS (SELECT e.*, CASE WHEN ic IS NULL AND mc IS NULL AND sc IS NULL THEN nm.cats END AS nc FROM e LEFT JOIN nm ON nm.nk = {S.norm_key('e.name')}),
o AS (SELECT event_id, list_sort(list_distinct(coalesce(ic, []) || coalesce(mc, []) || coalesce(sc, []) || coalesce(nc, [])
 || CASE WHEN mmsi LIKE '273%' THEN ['russian_mmsi'] ELSE [] END)) AS cats,
 concat_ws(',', CASE WHEN sc IS NOT NULL THEN 'callsign' END, CASE WHEN ic IS NOT NULL THEN 'imo' END, CASE WHEN mc IS NOT NULL THEN 'mmsi' END,
  CASE WHEN mmsi LIKE '273%' THEN 'russian_mmsi_mid' END, CASE WHEN nc IS NOT NULL THEN 'unique_name' END) AS matched_on FROM n)
SELECT event_id, array_to_string(cats, ',') AS categories, matched_on FROM o WHERE len(cats) > 0""")
def _(t):
    src = t.watchlist.withColumn("categories", matching.watch_categories("archive"))
    return matching.match_known(t.contacts, src).select(
        "event_id", F.array_join("categories", ",").alias("categories"), F.array_join("matched_on", ",").alias("matched_on"))


@query("jn03_unique_names", f"WITH {_KNOWN} SELECT nk AS name_key, array_to_string(cats, ',') AS categories FROM nm")
def _(t):
    src = t.watchlist.withColumn("categories", matching.watch_categories("archive"))
    return matching.unique_names(src).select("name_key", F.array_join("categories", ",").alias("categories"))


@query("jn04_flag_resolution", f"WITH {FLAGGED} SELECT * FROM flagged")
def _(t):
    return matching.resolve_flag(t.contacts, t.flags).select("event_id", "flag_detected", "flag_source")


@query("jn05_port_match", f"""
WITH {PORT_TERMS}, {port_ctes('d', 'destination')}, {port_ctes('p', 'last_port')}
SELECT event_id, coalesce(d.matched, false) AS declared, coalesce(d.hits, '') AS declared_hits, coalesce(p.matched, false) AS observed,
 coalesce(p.hits, '') AS observed_hits FROM v_contacts LEFT JOIN d ON d.text = destination LEFT JOIN p ON p.text = last_port""")
def _(t):
    terms = matching.port_terms(t.ports)
    out = matching.add_port_match(t.contacts, terms, {"destination": "declared", "last_port": "observed"})
    return out.select("event_id", "declared", F.array_join("declared_hits", ",").alias("declared_hits"), "observed",
                      F.array_join("observed_hits", ",").alias("observed_hits"))


@query("jn06_zone_assignment", f"WITH {ZONES} SELECT * FROM zones")
def _(t):
    return matching.zone_rows(t.contacts).select("event_id", "zone_id")


@query("jn07_location_metadata", f"""
WITH m AS (SELECT {S.digits('mmsi')} AS id, arg_max(name, line_no) AS meta_name, arg_max(source_list, line_no) AS meta_source FROM v_watchlist
 WHERE {S.digits('mmsi')} IS NOT NULL GROUP BY 1) SELECT event_id, meta_name, meta_source FROM v_contacts LEFT JOIN m ON id = {S.digits('mmsi')}""")
def _(t):
    meta = t.watchlist.select("mmsi", "line_no", F.col("name").alias("meta_name"), F.col("source_list").alias("meta_source"))
    return matching.attach_metadata(t.contacts, meta, "line_no").select("event_id", "meta_name", "meta_source")


def _classified_sources(t):
    s = t.watchlist.withColumn("categories", matching.watch_categories("snapshot"))
    return s.select("imo", "mmsi", "categories", F.lit(True).alias("is_priority_voi"),
                    F.col("track_sanctions").alias("sanctioned"), F.col("track_falseflag").alias("false_flag"))


@query("jn08_classification_enrichment", f"""
WITH s AS (SELECT imo, mmsi, track_sanctions, track_falseflag, [x FOR x IN ['watchlist', CASE WHEN track_sanctions THEN 'sanctions_shadowfleet' END,
 CASE WHEN track_shadowfleet THEN 'shadowfleet' END, CASE WHEN track_falseflag THEN 'falseflag_interest' END, CASE WHEN track_behavior THEN 'behavioral_voi' END]
 IF x IS NOT NULL] AS cats FROM v_watchlist),
k AS (SELECT 'imo:' || imo AS key, * FROM s WHERE length({S.digits('imo')}) = 7 UNION ALL SELECT 'mmsi:' || mmsi, * FROM s WHERE length({S.digits('mmsi')}) = 9),
i AS (SELECT key, list_sort(list_distinct(flatten(list(cats)))) AS cats, bool_or(track_sanctions) AS sanctioned, bool_or(track_falseflag) AS false_flag FROM k GROUP BY 1)
SELECT event_id, coalesce(array_to_string(cats, ','), '') AS categories, coalesce(sanctioned, false) AS sanctioned, coalesce(false_flag, false) AS false_flag,
 i.key IS NOT NULL AS priority FROM v_contacts LEFT JOIN i ON i.key = {S.ID_COMMON}""")
def _(t):
    flags = ("is_priority_voi", "sanctioned", "false_flag")
    index = matching.classification_index(_classified_sources(t), flags)
    rows = t.contacts.withColumn("identity_key", identity.id_common())
    return matching.enrich(rows, index, flags).select(
        "event_id", F.array_join("categories", ",").alias("categories"), "sanctioned", "false_flag",
        F.col("is_priority_voi").alias("priority"))


@query("jn18_radar_watch_match", f"""
WITH wi AS (SELECT {S.digits('imo')} AS id, arg_max(name, line_no) AS name FROM v_watchlist WHERE length({S.digits('imo')}) = 7 GROUP BY 1),
wm AS (SELECT {S.digits('mmsi')} AS id, arg_max(name, line_no) AS name FROM v_watchlist WHERE length({S.digits('mmsi')}) = 9 GROUP BY 1)
SELECT DISTINCT g.imo, g.mmsi, wi.id IS NOT NULL OR wm.id IS NOT NULL AS matched, concat_ws(',', CASE WHEN wi.id IS NOT NULL THEN 'imo' END,
 CASE WHEN wm.id IS NOT NULL THEN 'mmsi' END) AS basis, coalesce(wi.name, wm.name) AS name FROM v_grid g
LEFT JOIN wi ON wi.id = {S.digits('g.imo')} LEFT JOIN wm ON wm.id = {S.digits('g.mmsi')}""")
def _(t):
    out = matching.watch_match_basis(t.grid, t.watchlist)
    return out.select("imo", "mmsi", F.col("watchlist_match").alias("matched"), F.array_join("match_basis", ",").alias("basis"),
                      F.col("watchlist_name").alias("name")).distinct()


# A quarter of the rows show neither number, another one no MMSI; one MMSI is used by several ships.
_SHOWN = {"imo": "CASE WHEN event_id % 4 = 0 THEN '' ELSE imo END", "mmsi":
          "CASE WHEN event_id % 4 < 2 THEN '' WHEN event_id % 50 = 3 THEN '219000001' ELSE mmsi END"}


@query("jn19_alias_identity", f"""
WITH c AS (SELECT DISTINCT floor(epoch(observed_at) / 864000)::BIGINT AS period, 'imo:' || {S.sized('imo', 7)} AS imo, 'mmsi:' || {S.sized('mmsi', 9)} AS mmsi,
 'callsign:' || {S.norm_text('callsign')} AS callsign, 'name:' || {S.norm_text('name')} AS name
 FROM (SELECT * REPLACE ({_SHOWN['imo']} AS imo, {_SHOWN['mmsi']} AS mmsi) FROM v_contacts)),
o1 AS (SELECT period, mmsi AS alias, CASE WHEN count(DISTINCT imo) = 1 THEN min(imo) ELSE mmsi END AS canonical, count(DISTINCT imo) > 1 AS ambiguous FROM c WHERE mmsi IS NOT NULL GROUP BY period, mmsi),
c1 AS (SELECT c.*, coalesce(c.imo, o1.canonical) AS known FROM c LEFT JOIN o1 ON o1.period = c.period AND o1.alias = c.mmsi),
o2 AS (SELECT period, callsign AS alias, CASE WHEN count(DISTINCT known) = 1 THEN min(known) ELSE callsign END AS canonical, count(DISTINCT known) > 1 AS ambiguous FROM c1 WHERE callsign IS NOT NULL GROUP BY period, callsign),
c2 AS (SELECT c1.* REPLACE (coalesce(c1.known, o2.canonical) AS known) FROM c1 LEFT JOIN o2 ON o2.period = c1.period AND o2.alias = c1.callsign),
o3 AS (SELECT period, name AS alias, CASE WHEN count(DISTINCT known) = 1 THEN min(known) ELSE name END AS canonical, count(DISTINCT known) > 1 AS ambiguous FROM c2 WHERE name IS NOT NULL GROUP BY period, name)
SELECT DISTINCT period, imo AS alias, imo AS canonical, false AS ambiguous FROM c WHERE imo IS NOT NULL UNION ALL FROM o1 UNION ALL FROM o2 UNION ALL FROM o3""")
def _(t):
    return matching.alias_owners(t.contacts.withColumns({c: F.expr(sql) for c, sql in _SHOWN.items()}), days=10)


# --- sets ----------------------------------------------------------------------------

@query("set03_category_sets", """
SELECT event_id, concat_ws(',', CASE WHEN event_id % 2 = 0 THEN 'a' END, CASE WHEN event_id % 3 = 0 OR event_id % 2 = 0 THEN 'b' END,
 CASE WHEN event_id % 3 = 0 THEN 'c' END) AS joined, CASE WHEN event_id % 6 = 0 THEN 'b' ELSE '' END AS shared FROM v_contacts""")
def _(t):
    k, none = F.col("event_id"), F.array().cast("array<string>")
    x = F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(none)
    y = F.when(k % 3 == 0, F.array(F.lit("b"), F.lit("c"))).otherwise(none)
    return t.contacts.select("event_id", F.array_join(F.array_sort(F.array_union(x, y)), ",").alias("joined"),
                             F.array_join(F.array_intersect(x, y), ",").alias("shared"))


@query("set08_port_terms", f"WITH {PORT_TERMS} SELECT term, kind FROM terms")
def _(t):
    return matching.port_terms(t.ports).select("term", "kind")


# --- classification ------------------------------------------------------------------

@query("cls01_classify", f"""
WITH {CLASSIFIED} SELECT event_id, array_to_string(categories, ',') AS categories, matched_on, coalesce(band, '') AS band,
 declared AS to_russia_declared, confirmed AS from_russia_confirmed, t_s AS sanctioned, t_f AS shadow_fleet FROM classified""")
def _(t):
    return classified(t).select("event_id", F.array_join("categories", ",").alias("categories"), "matched_on",
                                F.coalesce("flag_risk_band", F.lit("")).alias("band"), "to_russia_declared",
                                "from_russia_confirmed", "sanctioned", "shadow_fleet")


@query("cls02_flag_risk_band", f"WITH {RISK} SELECT event_id, flag_detected, band, score FROM banded")
def _(t):
    return matching.assess_flag(t.contacts, t.flags).select(
        "event_id", "flag_detected", F.col("flag_risk_band").alias("band"), F.col("flag_risk_score").alias("score"))


@query("cls03_hard_flag", f"""
WITH {CLASSIFIED} SELECT event_id, hard_watch AND (band IS NOT NULL OR matched_on IS NOT NULL) AS hard, CASE WHEN band IS NULL AND matched_on IS NULL
 THEN 0 ELSE CAST(r_hard AS INT) + others END AS reasons FROM classified""")
def _(t):
    return classified(t).select("event_id", F.col("false_flag_hard_watch").alias("hard"),
                                F.size("false_flag_hard_reasons").alias("reasons"))


@query("cls04_neutral_context", f"""
WITH {CLASSIFIED} SELECT event_id FROM classified WHERE categories = ['neutral_tanker_context']""")
def _(t):
    return classified(t).where("neutral_tanker_context").select("event_id")


@query("cls05_portcall_confidence", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'confirmed' WHEN event_id % 3 = 0 THEN 'unconfirmed' WHEN event_id % 2 = 0
 THEN 'declared_destination_only' END AS confidence FROM v_contacts""")
def _(t):
    k = F.col("event_id")
    return t.contacts.select("event_id", cl.portcall_confidence(k % 5 == 0, k % 3 == 0, k % 2 == 0).alias("confidence"))


@query("cls06_watch_categories", f"""
SELECT line_no, array_to_string({_CATS}, ',') AS archive, concat_ws(',', CASE WHEN track_behavior THEN 'behavioral_voi' END,
 CASE WHEN track_falseflag THEN 'falseflag_interest' END, CASE WHEN track_sanctions THEN 'sanctions_shadowfleet' END,
 CASE WHEN track_shadowfleet THEN 'shadowfleet' END, 'watchlist') AS grid FROM v_watchlist""")
def _(t):
    return t.watchlist.select("line_no", F.array_join(matching.watch_categories("archive"), ",").alias("archive"),
                              F.array_join(matching.watch_categories("grid"), ",").alias("grid"))


@query("cls09_known_flags", f"""
WITH s AS (SELECT line_no, {_CATS} AS c FROM v_watchlist) SELECT line_no, list_contains(c, 'sanctions_shadowfleet') AS sanctioned,
 list_contains(c, 'falseflag_interest') AS false_flag, list_contains(c, 'behavioral_voi') AS behavioral_voi, true AS is_priority_voi FROM s""")
def _(t):
    rows = t.watchlist.withColumn("categories", matching.watch_categories("archive"))
    flags = matching.known_flags(F.col("categories"))
    return rows.select("line_no", *[flags[n].alias(n) for n in ("sanctioned", "false_flag", "behavioral_voi", "is_priority_voi")])


# --- statistics over the classified snapshot -----------------------------------------

@query("agg03_category_counts", f"""
WITH {CLASSIFIED} SELECT unnest(categories) AS category, count(*) AS n FROM classified GROUP BY 1""")
def _(t):
    return cl.category_counts(classified(t))


@query("agg04_snapshot_counters", f"""
WITH {CLASSIFIED} SELECT count(*) AS total_items, count(*) FILTER (confirmed) AS from_russia_confirmed, count(*) FILTER (declared) AS to_russia_declared_database_only,
 0::BIGINT AS recent_russian_portcall_unconfirmed_10d, count(*) FILTER (list_contains(categories, 'falseflag_interest')) AS falseflag_interest,
 count(*) FILTER (list_contains(categories, 'false_flag_watch')) AS false_flag_watch_hard, count(*) FILTER (list_contains(categories, 'recent_russian_portcall_10d')) AS recent_russian_portcall_10d,
 count(*) FILTER (list_contains(categories, 'neutral_tanker_context')) AS neutral_tanker_context, count(*) FILTER (list_contains(categories, 'watchlist')) AS watchlist FROM classified""")
def _(t):
    return cl.snapshot_counters(classified(t))


_TZ = f"""{CLASSIFIED}, tz AS (SELECT c.*, z.zone_id, list_contains(categories, 'neutral_tanker_context') AS neutral FROM classified c JOIN zones z ON z.event_id = c.event_id WHERE tanker)"""


@query("agg05_zone_stats", f"""
WITH {_TZ}, a AS (SELECT zone_id, count(*) AS total_tankers, count(*) FILTER (neutral) AS neutral_tankers, count(*) FILTER (NOT neutral) AS voi_tankers,
 count(*) FILTER (sog <= 3) AS slow_or_waiting, count(*) FILTER (regexp_matches(upper(destination), '{P.FOR_ORDER_PATTERN}')) AS for_order FROM tz GROUP BY 1)
SELECT *, CASE WHEN neutral_tankers >= 10 AND voi_tankers >= 1 THEN 'heightened_context' WHEN neutral_tankers >= 10 OR total_tankers >= 14 THEN 'watch'
 ELSE 'context' END AS level FROM a""")
def _(t):
    return cl.tanker_cluster_stats(classified(t))


@query("agg06_zone_entities", f"""
WITH {_TZ}, k AS (SELECT mmsi, bool_or(neutral) AS n, bool_or(NOT neutral) AS v FROM tz GROUP BY 1) SELECT count(*) AS unique_tankers,
 count(*) FILTER (n) AS neutral_tankers, count(*) FILTER (v) AS voi_tankers FROM k""")
def _(t):
    return cl.zone_entity_counts(classified(t), "mmsi")


@query("agg07_zone_examples", f"""
WITH {_TZ}, r AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY row_id) AS n FROM tz)
SELECT zone_id, n AS example_rank, n <= 8 AS within_limit, mmsi, destination FROM r""")
def _(t):
    return cl.zone_examples(classified(t), "row_id", 8).select("zone_id", "example_rank", "within_limit", "mmsi", "destination")


@query("win11_zone_cap", f"""
WITH {_TZ}, r AS (SELECT event_id, mmsi, observed_at, sog, row_number() OVER (PARTITION BY zone_id ORDER BY sog > 3, observed_at, event_id) AS n FROM tz WHERE neutral),
k AS (SELECT event_id, any_value(sog) AS sog, any_value(observed_at) AS o, min(n) AS zone_rank FROM r GROUP BY 1),
q AS (SELECT *, count(*) FILTER (zone_rank <= 80) OVER (ORDER BY sog > 3, o, event_id) AS total_rank FROM k)
SELECT event_id, zone_rank, total_rank, zone_rank <= 80 AND total_rank <= 260 AS within_limit FROM q""")
def _(t):
    items = classified(t).withColumn("last_seen", F.col("observed_at"))
    return cl.cap_neutral(items, cap=P.TankerCap(per_zone=80, total=260)).select("event_id", "zone_rank", "total_rank", "within_limit")


@query("set06_recent_portcalls", f"""
WITH {CLASSIFIED}, live AS (SELECT {S.ID_DEDUPE} AS k, event_id, 0 AS g FROM classified WHERE confirmed AND observed_at >= TIMESTAMP '2024-01-21'),
man AS (SELECT {S.ID_DEDUPE} AS k, line_no AS event_id, 1 AS g FROM v_watchlist WHERE notes = ''), u AS (SELECT * FROM live UNION ALL SELECT * FROM man)
SELECT k AS identity, arg_min(g, (g, event_id)) AS grp, arg_min(event_id, (g, event_id)) AS seq FROM u WHERE k IS NOT NULL GROUP BY 1""")
def _(t):
    live = classified(t).where("from_russia_confirmed AND observed_at >= TIMESTAMP '2024-01-21'").select(
        "imo", "mmsi", "callsign", "name", F.col("event_id").alias("seq"))
    manual = t.watchlist.where("notes = ''").select("imo", "mmsi", "callsign", "name", F.col("line_no").alias("seq"))
    out = merge.union_first_wins([live, manual], identity.id_dedupe(), "seq")
    return out.where("dedupe_key IS NOT NULL").select(F.col("dedupe_key").alias("identity"), "grp", "seq")


