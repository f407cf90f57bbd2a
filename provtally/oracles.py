"""SQL (DuckDB) for every query, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from provtally import fixtures as fx
from provtally.operators.scale import NO_DATA_COLOR, PALETTE, PATTERNS

_CODES = "[" + ", ".join(f"'{c}'" for c in fx.NATION_CODES) + "]"


def _vid(key: str) -> str:
    return (
        f"CASE WHEN {key} % 97 = 0 THEN 'bad!' || CAST({key} AS VARCHAR)"
        f" ELSE 'V' || lpad(CAST({key} AS VARCHAR), 10, '0') END"
    )


# Each entry may use the ones before it.
_CTES = {
    "obs": f"""SELECT 'ds-' || lower(l_returnflag) || lower(l_linestatus) AS dataset_id,
        {_vid('l_orderkey')} AS video_id, l_orderkey FROM lineitem""",
    "res": f"""SELECT {_vid('o_orderkey')} AS video_id, o_custkey AS channel_key,
        CASE WHEN o_orderkey % 97 = 0 THEN 'invalid'
             WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'unavailableUnclassified'
             WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'retryableOrPending'
             WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'terminalFailure'
             ELSE 'resolved' END AS state FROM orders""",
    "ch": f"""SELECT c_custkey AS channel_key, c_name AS display_name,
        CASE WHEN c_nationkey % 8 = 7 THEN 'XX' ELSE ({_CODES})[c_nationkey + 1] END AS country FROM customer""",
    "ds": """SELECT dataset_id, 'Snapshot ' || upper(substr(dataset_id, 4, 2)) AS display_name, 'v1' AS version,
        CASE WHEN dataset_id LIKE 'ds-n%' THEN 'Comparison' ELSE 'Candidate' END AS corpus_class,
        CASE substr(dataset_id, 4, 1) WHEN 'a' THEN 'MediaIndex' WHEN 'n' THEN 'MetadataOnly'
             ELSE 'SubtitleIndex' END AS source_kind,
        CASE substr(dataset_id, 4, 1) WHEN 'a' THEN 'Clip' WHEN 'n' THEN 'Video' ELSE 'Segment' END
             AS occurrence_unit,
        'https://example.org/' || dataset_id AS source_citation,
        'sha256:' || sha256(dataset_id || '|' || CAST(count(*) AS VARCHAR) || '|' ||
             CAST(sum(l_orderkey) AS VARCHAR)) AS snapshot_digest
        FROM obs GROUP BY dataset_id""",
    "flt": """SELECT 'all' AS filter_key, dataset_id, 0 AS band FROM ds
        UNION ALL SELECT lower(corpus_class), dataset_id, 1 FROM ds
        UNION ALL SELECT dataset_id, dataset_id, 2 FROM ds""",
    "keys": "SELECT filter_key, band FROM flt GROUP BY filter_key, band",
    "vid": """SELECT filter_key, video_id, count(*) AS n FROM obs JOIN flt USING (dataset_id)
        GROUP BY filter_key, video_id""",
    "vs": """SELECT v.filter_key, v.video_id, v.n, r.channel_key,
        CASE WHEN NOT regexp_full_match(v.video_id, '[A-Za-z0-9_-]{11}') THEN 'invalid'
             ELSE coalesce(r.state, 'retryableOrPending') END AS state
        FROM vid v LEFT JOIN res r USING (video_id)""",
    "vc": """SELECT filter_key, video_id, n, vs.channel_key, coalesce(country, 'XX') AS country
        FROM vs LEFT JOIN ch USING (channel_key) WHERE state = 'resolved'""",
    "cs": """SELECT filter_key, country, count(DISTINCT channel_key) AS creator_count,
        count(*) AS represented_video_count, CAST(sum(n) AS BIGINT) AS source_occurrence_count,
        count(*) AS resolved_video_count, CAST(0 AS BIGINT) AS unavailable_video_count
        FROM vc GROUP BY filter_key, country""",
    "cov": """SELECT filter_key, CAST(sum(n) AS BIGINT) AS input_occurrence_count,
        count(*) AS distinct_input_video_count,
        count(*) FILTER (state = 'resolved') AS resolved,
        count(*) FILTER (state = 'unavailableUnclassified') AS "unavailableUnclassified",
        count(*) FILTER (state = 'retryableOrPending') AS "retryableOrPending",
        count(*) FILTER (state = 'invalid') AS invalid,
        count(*) FILTER (state = 'terminalFailure') AS "terminalFailure"
        FROM vs GROUP BY filter_key""",
    "head": """SELECT v.filter_key,
        (SELECT count(DISTINCT channel_key) FROM vc WHERE vc.filter_key = v.filter_key) AS creator_count,
        count(*) AS represented_video_count, CAST(sum(n) AS BIGINT) AS source_occurrence_count,
        (SELECT count(*) FROM cs WHERE cs.filter_key = v.filter_key AND country <> 'XX') AS represented_country_count,
        (SELECT count(*) FROM cs WHERE cs.filter_key = v.filter_key) AS country_bucket_count,
        (SELECT count(DISTINCT channel_key) FROM vc WHERE vc.filter_key = v.filter_key AND country <> 'XX')
            AS known_country_channel_count,
        (SELECT count(DISTINCT channel_key) FROM vc WHERE vc.filter_key = v.filter_key AND country = 'XX')
            AS unknown_country_channel_count
        FROM vid v GROUP BY v.filter_key""",
    "cr": """SELECT vc.channel_key, ch.display_name, vc.country, count(*) AS represented_video_count
        FROM vc JOIN ch USING (channel_key) WHERE filter_key = 'all'
        GROUP BY vc.channel_key, ch.display_name, vc.country""",
    "crd": """SELECT vc.channel_key, vc.country, vc.filter_key AS dataset_id, count(*) AS v
        FROM vc WHERE filter_key IN (SELECT dataset_id FROM ds)
        GROUP BY vc.channel_key, vc.country, vc.filter_key""",
    "pub": f"""SELECT channel_key, 'pk_' || substr(sha256('{fx.KEY_SALT}' || CAST(channel_key AS VARCHAR)), 1, 32)
        AS public_channel_key, display_name, country, represented_video_count
        FROM cr WHERE represented_video_count >= {fx.DISCLOSURE_THRESHOLD} AND channel_key % 50 <> 0""",
    "ranked": f"""SELECT *, CAST(floor((rank - 1) / {fx.PAGE_SIZE}) AS BIGINT) AS page FROM (
        SELECT pub.*, 'representedVideoCountDesc' AS sort_order,
            row_number() OVER (PARTITION BY country ORDER BY represented_video_count DESC, display_name,
                public_channel_key) AS rank, count(*) OVER (PARTITION BY country) AS total_rows FROM pub
        UNION ALL SELECT pub.*, 'displayNameAsc',
            row_number() OVER (PARTITION BY country ORDER BY display_name, public_channel_key),
            count(*) OVER (PARTITION BY country) FROM pub)""",
    "pages": f"""SELECT country, sort_order, total_rows, page_count, unnest(range(page_count)) AS page FROM (
        SELECT country, s AS sort_order, count(*) AS total_rows,
            CAST(ceil(count(*) / {fx.PAGE_SIZE}) AS BIGINT) AS page_count
        FROM pub, (SELECT unnest(['representedVideoCountDesc', 'displayNameAsc']) AS s) GROUP BY country, s)""",
    "ml": """SELECT filter_key, country, 'creators' AS metric, creator_count AS value FROM cs
        UNION ALL SELECT filter_key, country, 'videos', represented_video_count FROM cs
        UNION ALL SELECT filter_key, country, 'occurrences', source_occurrence_count FROM cs""",
    "vals": """SELECT filter_key, metric, list(value ORDER BY value) FILTER (value > 0) AS vs, count(*) AS countries
        FROM ml GROUP BY filter_key, metric""",
    "brk": """SELECT filter_key, metric, e AS q, vs, CAST(floor(vs[lo + 1] + (vs[hi + 1] - vs[lo + 1]) * (pos - lo) + 0.5)
            AS BIGINT) AS break_value
        FROM (SELECT *, CAST(floor(pos) AS BIGINT) AS lo, CAST(ceil(pos) AS BIGINT) AS hi FROM (
            SELECT filter_key, metric, vs, e, CAST(e AS DOUBLE) / 5.0 * (len(vs) - 1) AS pos
            FROM vals, (SELECT unnest([1, 2, 3, 4]) AS e) WHERE len(vs) > 0))""",
    "edges": """SELECT filter_key, metric, any_value(vs) AS vs,
        list_sort(list_distinct(list_concat([list_min(any_value(vs)), list_max(any_value(vs))], list(break_value))))
            AS edges FROM brk GROUP BY filter_key, metric""",
    "bins": f"""SELECT filter_key, metric, method, min, max,
            CAST(row_number() OVER (PARTITION BY filter_key, metric ORDER BY e) - 1 AS INTEGER) AS position,
            CASE WHEN min = max THEN format('{{:,}}', min) ELSE format('{{:,}}–{{:,}}', min, max) END AS label,
            ({list(PALETTE)})[shade + 1] AS color, ({list(PATTERNS)})[shade + 1] AS pattern
        FROM (SELECT filter_key, metric, 'quantile' AS method, e,
                CASE WHEN e = 0 THEN edges[1] ELSE edges[e + 1] + 1 END AS min, edges[e + 2] AS max,
                least(CAST(floor(e / CAST(greatest(len(edges) - 2, 1) AS DOUBLE) * 6) AS INTEGER), 5) AS shade
            FROM (SELECT *, unnest(range(len(edges) - 1)) AS e FROM edges WHERE len(edges) > 1)
            UNION ALL SELECT filter_key, metric, 'single-value', 0, edges[1], edges[1], 5 FROM edges
            WHERE len(edges) = 1) WHERE min <= max""",
    "cb": f"""SELECT ml.filter_key, ml.metric, ml.country, ml.value, coalesce(b.label, f.label) AS bin_label,
            coalesce(b.color, f.color) AS color, coalesce(b.pattern, f.pattern) AS pattern FROM ml
        LEFT JOIN bins b ON ml.filter_key = b.filter_key AND ml.metric = b.metric AND ml.value BETWEEN b.min AND b.max
        LEFT JOIN bins f ON ml.filter_key = f.filter_key AND ml.metric = f.metric AND f.position = (
            CASE WHEN ml.value = 0 THEN 0 ELSE (SELECT max(position) FROM bins x
                WHERE x.filter_key = ml.filter_key AND x.metric = ml.metric) END)""",
    "names": """SELECT * FROM (VALUES ('AR', 'Argentina'), ('AU', 'Australia'), ('BR', 'Brazil'), ('CA', 'Canada'),
        ('CN', 'China'), ('DE', 'Germany'), ('EG', 'Egypt'), ('ES', 'Spain'), ('FR', 'France'),
        ('GB', 'United Kingdom'), ('ID', 'Indonesia'), ('IN', 'India'), ('IT', 'Italy'), ('JP', 'Japan'),
        ('KE', 'Kenya'), ('KR', 'South Korea'), ('MX', 'Mexico'), ('NG', 'Nigeria'), ('NO', 'Norway'),
        ('NZ', 'New Zealand'), ('PL', 'Poland'), ('SE', 'Sweden'), ('TR', 'Turkey'), ('US', 'United States'),
        ('ZA', 'South Africa'), ('XX', 'Unknown country')) t(country, country_name)""",
    "buckets": f"""SELECT country, count(*) AS channels FROM (
        SELECT CASE WHEN upper(raw) ~ '^[A-Z][A-Z]$' THEN upper(raw) ELSE 'XX' END AS country FROM (
            SELECT CASE WHEN c_custkey % 5 = 1 THEN lower(code) WHEN c_custkey % 5 = 2 THEN code || '1'
                WHEN c_custkey % 25 = 3 THEN NULL WHEN c_custkey % 25 = 8 THEN 'qq' ELSE code END AS raw
            FROM (SELECT c_custkey, ({_CODES})[c_nationkey + 1] AS code FROM customer))) GROUP BY country""",
    # Links: the raw value of each parameter, and then what becomes of it.
    "lk": """SELECT event_id,
        CASE event_id % 7 WHEN 0 THEN 'fixture-1' WHEN 1 THEN 'a b' END AS release,
        CASE WHEN event_id % 4 = 0 THEN ['ds-ro', 'ds-af'] WHEN event_id % 4 = 1 THEN
            ['ds-af', 'DS!', 'ds-zz', 'ds-af'] WHEN event_id % 4 = 2 AND user_id % 3 = 0 THEN ['ds-nf'] ELSE [] END
            AS datasets,
        CASE user_id % 4 WHEN 0 THEN ['Candidate'] WHEN 1 THEN ['Comparison', 'Other'] ELSE [] END AS corpus,
        CASE event_id % 5 WHEN 0 THEN 'usa' WHEN 1 THEN 'us' WHEN 2 THEN 'IT' WHEN 3 THEN 'DE' END AS country,
        CASE event_id % 3 WHEN 0 THEN 'videos' WHEN 1 THEN 'creators' ELSE 'likes' END AS metric,
        CASE user_id % 5 WHEN 0 THEN 'table' WHEN 1 THEN 'grid' END AS view,
        CASE user_id % 6 WHEN 0 THEN 'displayNameAsc' WHEN 1 THEN 'newest' END AS sort,
        CASE event_id % 11 WHEN 0 THEN CAST(user_id % 9 AS VARCHAR) WHEN 1 THEN '!bad' END AS cursor
        FROM events""",
    "known": "SELECT country FROM cs WHERE filter_key = 'all'",
    "sel": """SELECT event_id, lk.release AS raw_release, lk.country AS raw_country, lk.metric AS raw_metric,
        lk.view AS raw_view, lk.sort AS raw_sort, lk.cursor AS raw_cursor, lk.datasets AS raw_datasets,
        lk.corpus AS raw_corpus,
        CASE WHEN lk.release = 'fixture-1' THEN lk.release END AS release,
        list_sort(list_distinct(list_filter(lk.datasets, lambda d: d LIKE 'ds-__' AND d <> 'ds-zz'))) AS datasets,
        list_sort(list_distinct(list_filter(lk.corpus, lambda c: c <> 'Other'))) AS corpus_classes,
        k.country AS country,
        CASE WHEN lk.metric = 'likes' THEN 'creators' ELSE lk.metric END AS metric,
        CASE WHEN lk.view = 'table' THEN 'table' ELSE 'map' END AS view,
        CASE WHEN lk.sort = 'displayNameAsc' THEN lk.sort ELSE 'representedVideoCountDesc' END AS sort,
        CASE WHEN k.country IS NOT NULL AND lk.cursor <> '!bad' THEN lk.cursor END AS cursor
        FROM lk LEFT JOIN known k ON upper(lk.country) = k.country""",
    "corr": """SELECT event_id, 'release' AS field, raw_release AS rejected, 'not a valid release identifier' AS reason
            FROM sel WHERE raw_release = 'a b'
        UNION ALL SELECT event_id, 'datasets', d, CASE WHEN d = 'DS!' THEN 'not a valid dataset identifier'
            ELSE 'dataset is not in this release' END FROM (SELECT event_id, unnest(raw_datasets) AS d FROM sel)
            WHERE d IN ('DS!', 'ds-zz')
        UNION ALL SELECT event_id, 'corpusClasses', c, 'unknown corpus class'
            FROM (SELECT event_id, unnest(raw_corpus) AS c FROM sel) WHERE c = 'Other'
        UNION ALL SELECT event_id, 'country', raw_country, CASE WHEN length(raw_country) <> 2
            THEN 'not an ISO 3166 alpha-2 code' ELSE 'country has no data in this release' END
            FROM sel WHERE raw_country IS NOT NULL AND country IS NULL
        UNION ALL SELECT event_id, 'metric', raw_metric, 'unknown metric' FROM sel WHERE raw_metric = 'likes'
        UNION ALL SELECT event_id, 'view', raw_view, 'unknown view mode' FROM sel WHERE raw_view = 'grid'
        UNION ALL SELECT event_id, 'sort', raw_sort, 'unknown sort order' FROM sel WHERE raw_sort = 'newest'
        UNION ALL SELECT event_id, 'cursor', raw_cursor, CASE WHEN raw_cursor = '!bad' THEN 'not a valid page cursor'
            ELSE 'a page cursor requires a country selection' END
            FROM sel WHERE raw_cursor = '!bad' OR (raw_cursor IS NOT NULL AND country IS NULL)""",
    "fl": """SELECT filter_key, band, list(dataset_id ORDER BY dataset_id) AS datasets,
        list_sort(list_distinct(list(corpus_class))) AS corpus_classes,
        row_number() OVER (ORDER BY band, filter_key) - 1 AS position
        FROM flt JOIN ds USING (dataset_id) GROUP BY filter_key, band""",
    "rs": """SELECT event_id, datasets, corpus_classes,
        coalesce(hit, 'all') AS filter_key,
        (len(datasets) = 0 AND len(corpus_classes) = 0) OR hit IS NOT NULL AS exact
        FROM (SELECT s.event_id, s.datasets, s.corpus_classes, (SELECT min_by(f.filter_key, f.position) FROM fl f
            WHERE (len(s.datasets) > 0 OR len(s.corpus_classes) > 0)
            AND (len(s.datasets) = 0 OR f.datasets = s.datasets)
            AND (len(s.corpus_classes) = 0 OR f.corpus_classes = s.corpus_classes)) AS hit FROM sel s)""",
    # Documents.
    "covj": """SELECT filter_key, '{"inputOccurrenceCount":' || input_occurrence_count ||
        ',"distinctInputVideoCount":' || distinct_input_video_count || ',"partition":{"resolved":' || resolved ||
        ',"unavailableUnclassified":' || "unavailableUnclassified" || ',"retryableOrPending":' ||
        "retryableOrPending" || ',"invalid":' || invalid || ',"terminalFailure":' || "terminalFailure" ||
        '},"resolvedChannelCount":' || creator_count || ',"knownCountryChannelCount":' ||
        known_country_channel_count || ',"unknownCountryChannelCount":' || unknown_country_channel_count || '}'
        AS coverage FROM cov JOIN head USING (filter_key)""",
    "ovj": f"""SELECT CASE WHEN filter_key = 'all' THEN 'releases/{fx.RELEASE_ID}/overview.json'
            ELSE 'releases/{fx.RELEASE_ID}/filters/' || filter_key || '.json' END AS path,
        '{{"schemaVersion":"1.0.0","releaseId":"{fx.RELEASE_ID}","filter":{{"datasets":["' ||
        array_to_string(fl.datasets, '","') || '"],"corpusClasses":["' || array_to_string(fl.corpus_classes, '","') ||
        '"]}},"countries":[' || (SELECT string_agg('{{"country":"' || country || '","creatorCount":' || creator_count ||
            ',"representedVideoCount":' || represented_video_count || ',"sourceOccurrenceCount":' ||
            source_occurrence_count || ',"resolvedVideoCount":' || resolved_video_count ||
            ',"unavailableVideoCount":0}}', ',' ORDER BY country) FROM cs WHERE cs.filter_key = head.filter_key) ||
        '],"coverage":' || coverage || ',"creatorCount":' || creator_count || ',"representedVideoCount":' ||
        represented_video_count || ',"representedCountryCount":' || represented_country_count || '}}' AS body
        FROM head JOIN covj USING (filter_key) JOIN fl USING (filter_key)""",
    "brj": """SELECT channel_key, string_agg('{"datasetId":"' || dataset_id || '","representedVideoCount":' || v || '}',
        ',' ORDER BY dataset_id) AS b FROM crd GROUP BY channel_key""",
    "pgj": f"""SELECT country, sort_order, page, '{{"country":"' || country || '","sortOrder":"' || sort_order ||
            '","rows":[' || string_agg('{{"publicChannelKey":"' || public_channel_key || '","displayName":"' ||
            display_name || '","country":"' || country || '","representedVideoCount":' || represented_video_count ||
            ',"datasetBreakdown":[' || b || '],"lastObservedAt":"{fx.LAST_OBSERVED}"}}', ',' ORDER BY rank) ||
            '],"nextCursor":' || CASE WHEN (page + 1) * {fx.PAGE_SIZE} < max(total_rows)
                THEN '"' || (page + 1) || '"' ELSE 'null' END ||
            ',"pageSize":{fx.PAGE_SIZE},"totalRows":' || max(total_rows) || '}}' AS body
        FROM ranked JOIN brj USING (channel_key) GROUP BY country, sort_order, page""",
    "idx": f"""SELECT country, sort_order, '"' || sort_order || '":[' || string_agg('"releases/{fx.RELEASE_ID}/creators/' ||
        country || '/' || sort_order || '/page-' || page || '.json"', ',' ORDER BY page) || ']' AS j
        FROM pages GROUP BY country, sort_order""",
    "shj": f"""SELECT cs.country, 'releases/{fx.RELEASE_ID}/countries/' || cs.country || '.json' AS path,
        '{{"country":"' || cs.country || '","creatorCount":' || creator_count || ',"representedVideoCount":' ||
        represented_video_count || ',"sourceOccurrenceCount":' || source_occurrence_count ||
        ',"coverage":{{"inputOccurrenceCount":' || source_occurrence_count || ',"distinctInputVideoCount":' ||
        represented_video_count || ',"partition":{{"resolved":' || represented_video_count ||
        ',"unavailableUnclassified":0,"retryableOrPending":0,"invalid":0,"terminalFailure":0}},' ||
        '"resolvedChannelCount":' || creator_count || ',"knownCountryChannelCount":' ||
        CASE WHEN cs.country = 'XX' THEN 0 ELSE creator_count END || ',"unknownCountryChannelCount":' ||
        CASE WHEN cs.country = 'XX' THEN creator_count ELSE 0 END || '}},"datasetBreakdown":[' ||
        (SELECT string_agg('{{"datasetId":"' || dataset_id || '","representedVideoCount":' || v || '}}', ','
            ORDER BY dataset_id) FROM (SELECT dataset_id, sum(crd.v) AS v FROM crd WHERE crd.country = cs.country
            GROUP BY dataset_id)) || '],"firstPage":' || coalesce(p.body, '{{"country":"' || cs.country ||
            '","sortOrder":"representedVideoCountDesc","rows":[],"nextCursor":null,"pageSize":{fx.PAGE_SIZE},' ||
            '"totalRows":0}}') || ',"pageIndex":{{' ||
        coalesce(a.j, '"representedVideoCountDesc":[]') || ',' || coalesce(n.j, '"displayNameAsc":[]') || '}}}}' AS body
        FROM cs LEFT JOIN pgj p ON p.country = cs.country AND p.page = 0 AND p.sort_order = 'representedVideoCountDesc'
        LEFT JOIN idx a ON a.country = cs.country AND a.sort_order = 'representedVideoCountDesc'
        LEFT JOIN idx n ON n.country = cs.country AND n.sort_order = 'displayNameAsc'
        WHERE filter_key = 'all'""",
    "docs": f"""SELECT path, 'overview' AS kind, body FROM ovj
        UNION ALL SELECT path, 'shard', body FROM shj
        UNION ALL SELECT 'releases/{fx.RELEASE_ID}/creators/' || country || '/' || sort_order || '/page-' || page ||
            '.json', 'page', body FROM pgj""",
}

_PERCENT = "(CAST({p} AS DOUBLE) / {t} * 100)"


def _share(part: str, total: str) -> str:
    p = _PERCENT.format(p=part, t=f"nullif({total}, 0)")
    tenths = f"floor({p} * 10)"
    s = f"({p} * 16 + {p} * 4)"
    up = (
        f"(CASE WHEN {s} > {tenths} * 2 + 1 OR ({s} = {tenths} * 2 + 1 AND {p} * 4 - ({s} - {p} * 16) >= 0)"
        f" THEN 1 ELSE 0 END)"
    )
    return (
        f"CASE WHEN {total} = 0 THEN '—' WHEN {p} > 0 AND {p} < 0.1::DOUBLE THEN '<0.1%'"
        f" WHEN {p} < 100 AND {p} > 99.9::DOUBLE THEN '>99.9%'"
        f" ELSE printf('%.1f', ({tenths} + {up}) / 10.0::DOUBLE) || '%' END"
    )


def _with(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES.items())
    return f"WITH {ctes}\n{body}"


# Rows and multiset digest of (dataset_id, video_id), written out per row.
_MULTISET = """count(*) AS occurrences, CAST(count(*) AS VARCHAR) || '-' || CAST(sum(CAST('0x' || substr(md5(
    length(dataset_id) || ':' || dataset_id || length(video_id) || ':' || video_id), 1, 15) AS BIGINT)) % 2305843009213693951 AS VARCHAR) AS digest"""


def _hex_digit(path: str) -> str:
    return f"CAST('0x' || substr(md5({path}), 1, 1) AS INTEGER)"


_STATE_ROWS = (
    (0, "Resolved", "resolved", "Matched to a channel."),
    (1, "Unavailable", '"unavailableUnclassified"', "The metadata API did not return these and did not say why."),
    (2, "Pending", '"retryableOrPending"', "Not yet resolved at this release''s cutoff."),
    (3, "Invalid identifier", "invalid", "Did not match the supported identifier grammar."),
    (4, "Could not resolve", '"terminalFailure"', "Resolution failed permanently under the retry policy."),
)

_SELECTION_COLUMNS = """event_id, release, array_to_string(datasets, ',') AS datasets,
    array_to_string(corpus_classes, ',') AS corpus_classes, country, metric, view, sort, cursor"""

_FALLBACK = (
    " These are the full release figures; this release does not publish that exact combination."
)

_BODIES = {
    "country_summary": "SELECT * FROM cs",
    "headline_totals": "SELECT * FROM head",
    "represented_videos": "SELECT filter_key, count(*) AS represented_video_count FROM vid GROUP BY filter_key",
    "source_occurrences": """SELECT filter_key, count(*) AS source_occurrence_count FROM obs JOIN flt USING (dataset_id)
        GROUP BY filter_key""",
    "creators": "SELECT filter_key, count(DISTINCT channel_key) AS creator_count FROM vc GROUP BY filter_key",
    "filter_overview": "SELECT * FROM head WHERE filter_key IN (SELECT dataset_id FROM ds)",
    "corpus_overview": "SELECT * FROM head WHERE filter_key IN ('candidate', 'comparison')",
    "coverage_partition": "SELECT * FROM cov",
    "coverage_shares": " UNION ALL ".join(
        f"SELECT filter_key, CAST({i} AS INTEGER) AS position, '{label}' AS state_label, {col} AS videos,"
        f" {_share(col, 'distinct_input_video_count')} AS share, '{note}' AS note FROM cov"
        for i, label, col, note in _STATE_ROWS
    )
    + """ UNION ALL SELECT filter_key, 5, 'Total', distinct_input_video_count, '100%',
        'Every identifier is counted exactly once.' FROM cov""",
    "channel_country_split": f"""SELECT filter_key, 0 AS position, 'Declared a country' AS channels,
            known_country_channel_count AS channel_count,
            {_share('known_country_channel_count', 'creator_count')} AS share FROM head
        UNION ALL SELECT filter_key, 1, 'No declared country', unknown_country_channel_count,
            {_share('unknown_country_channel_count', 'creator_count')} FROM head
        UNION ALL SELECT filter_key, 2, 'Resolved channels', creator_count, '100%' FROM head""",
    "headline_cards": """SELECT filter_key, 0 AS position, 'Creators' AS label,
            format('{:,}', creator_count) AS value, 'Distinct channels resolved within this filter' AS note FROM head
        UNION ALL SELECT filter_key, 1, 'Represented videos', format('{:,}', represented_video_count),
            'Distinct source-video identifiers, counted once each' FROM head
        UNION ALL SELECT filter_key, 2, 'Source occurrences', format('{:,}', source_occurrence_count),
            'Retained source records; higher than the video count because sources repeat' FROM head
        UNION ALL SELECT filter_key, 3, 'Countries represented', format('{:,}', represented_country_count),
            CASE WHEN unknown_country_channel_count > 0 THEN 'Excludes ' ||
                format('{:,}', unknown_country_channel_count) || ' channels with no declared country'
                ELSE 'Channels with no declared country are excluded' END FROM head""",
    "page_lines": """SELECT country, sort_order, page, 'Showing ' || format('{:,}', count(*)) || ' of ' ||
            format('{:,}', max(total_rows)) || ' published creators' ||
            CASE WHEN max(total_rows) > %(size)s THEN ', page ' || (page + 1) || ' of ' ||
                CAST(ceil(max(total_rows) / %(size)s) AS BIGINT) ELSE '' END AS line
        FROM ranked GROUP BY country, sort_order, page""" % {"size": fx.PAGE_SIZE},
    "country_lines": """SELECT country, country_name || ': ' || format('{:,}', creator_count) || ' creators, ' ||
            format('{:,}', represented_video_count) || ' represented videos, ' ||
            format('{:,}', (SELECT count(*) FROM pub WHERE pub.country = cs.country)) ||
            ' published creators listed.' AS line
        FROM cs JOIN names USING (country) WHERE filter_key = 'all'""",
    "dataset_breakdown": """SELECT country, dataset_id, CAST(sum(v) AS BIGINT) AS represented_video_count FROM crd
        GROUP BY country, dataset_id""",
    "dataset_overlap": """SELECT CAST(d AS INTEGER) AS dataset_count, count(*) AS videos,
            CAST(sum(count(*)) OVER () AS BIGINT) AS combined_videos,
            CAST(sum(d * count(*)) OVER () AS BIGINT) AS summed_videos,
            CAST(sum(d * count(*)) OVER () - sum(count(*)) OVER () AS BIGINT) AS overshoot
        FROM (SELECT video_id, count(DISTINCT dataset_id) AS d FROM obs GROUP BY video_id) GROUP BY d""",
    "dataset_pairs": """SELECT a.dataset_id AS dataset_a, b.dataset_id AS dataset_b, count(*) AS shared_videos
        FROM (SELECT DISTINCT dataset_id, video_id FROM obs) a JOIN (SELECT DISTINCT dataset_id, video_id FROM obs) b
        ON a.video_id = b.video_id AND a.dataset_id < b.dataset_id GROUP BY 1, 2""",
    "occurrences_by_unit": """SELECT occurrence_unit, source_kind, count(*) AS occurrences,
        count(DISTINCT dataset_id) AS datasets FROM obs JOIN ds USING (dataset_id) GROUP BY 1, 2""",
    "dataset_catalog": "SELECT *, substr(replace(snapshot_digest, 'sha256:', ''), 1, 12) AS digest_label FROM ds",
    "id_grammar": """SELECT regexp_full_match(video_id, '[A-Za-z0-9_-]{11}') AS valid, count(*) AS occurrences FROM obs
        GROUP BY 1""",
    "leak_scan": """SELECT CASE WHEN length(token) = 11 THEN 'video' ELSE 'channel' END AS kind, token,
            count(*) AS occurrences, count(DISTINCT doc_id) AS texts
        FROM (SELECT doc_id, unnest(string_split_regex(text, '[^A-Za-z0-9_-]+')) AS token FROM documents)
        WHERE length(token) = 11 OR (length(token) = 24 AND token LIKE 'UC%') GROUP BY token""",
    "country_bucket": "SELECT * FROM buckets",
    "country_display": """SELECT country, channels, coalesce(country_name, country) AS country_name
        FROM buckets LEFT JOIN names USING (country)""",
    "public_keys": f"""SELECT c_custkey AS channel_key,
        'pk_' || substr(sha256('{fx.KEY_SALT}' || CAST(c_custkey AS VARCHAR)), 1, 32) AS public_channel_key
        FROM customer""",
    "metadata_asof": """SELECT user_id AS channel_key, event_id AS observation_id, event_type AS display_name, value,
            strftime(ts, '%b %-d, %Y, %-I:%M %p') AS read_label
        FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "release_asof": """WITH c(release_id, cutoff) AS (VALUES ('r1', TIMESTAMP '2024-01-08 10:00:00'),
            ('r2', TIMESTAMP '2024-01-20 00:00:00'), ('r3', TIMESTAMP '2024-01-25 22:30:00'))
        SELECT release_id, user_id AS channel_key, event_id AS observation_id, event_type AS display_name, value
        FROM c JOIN events ON ts <= cutoff
        QUALIFY row_number() OVER (PARTITION BY release_id, user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "snapshot_check": f"""WITH new AS (SELECT CASE dataset_id WHEN 'ds-ro' THEN 'ds-new' ELSE dataset_id END AS dataset_id,
            CASE WHEN dataset_id = 'ds-nf' AND l_orderkey <= 40 THEN reverse(video_id) ELSE video_id END AS video_id
            FROM obs, range(CASE WHEN l_orderkey > 40 THEN 1 WHEN dataset_id = 'ds-af' THEN 0
                WHEN dataset_id = 'ds-ao' THEN 2 ELSE 1 END)),
        was AS (SELECT dataset_id, {_MULTISET} FROM obs GROUP BY dataset_id),
        now AS (SELECT dataset_id, {_MULTISET} FROM new GROUP BY dataset_id)
        SELECT dataset_id, was.occurrences AS pinned_occurrences, now.occurrences, was.digest AS pinned_digest, now.digest,
            CASE WHEN was.digest IS NULL THEN 'unpinned' WHEN now.digest IS NULL THEN 'missing'
                 WHEN was.digest = now.digest THEN 'ok' WHEN now.occurrences < was.occurrences THEN 'lost'
                 WHEN now.occurrences > was.occurrences THEN 'added' ELSE 'changed' END AS status
        FROM was FULL JOIN now USING (dataset_id)""",
    "input_checks": """SELECT 'foreign_dataset_rows' AS "check", count(*) AS violations FROM lineitem
            WHERE l_orderkey % 90 = 0 OR l_orderkey % 91 = 0
        UNION ALL SELECT 'unknown_state_rows', CAST(coalesce(sum(CASE WHEN o_custkey % 50 = 1 THEN 3 ELSE 1 END), 0) AS BIGINT)
            FROM orders WHERE o_custkey % 70 = 0 OR o_custkey % 71 = 0
        UNION ALL SELECT 'repeated_resolutions', 2 * count(*) FROM orders WHERE o_custkey % 50 = 1
        UNION ALL SELECT 'repeated_channels', count(*) FROM customer WHERE c_custkey % 40 = 0 AND c_custkey % 33 <> 0
        UNION ALL SELECT 'channels_without_key', CAST(sum(CASE WHEN c_custkey % 40 = 0 THEN 2 ELSE 1 END) AS BIGINT)
            FROM customer WHERE c_custkey % 33 = 0""",
    "removals_totals": """SELECT filter_key, state, CASE WHEN state = 'resolved' THEN coalesce(country, 'XX') END AS country,
            count(DISTINCT CASE WHEN state = 'resolved' THEN channel_key END) AS creators, count(*) AS videos,
            CAST(sum(n) AS BIGINT) AS occurrences
        FROM vs LEFT JOIN ch USING (channel_key) WHERE NOT (state = 'resolved' AND channel_key % 50 = 0)
        GROUP BY filter_key, state, CASE WHEN state = 'resolved' THEN coalesce(country, 'XX') END""",
    "metric_long": "SELECT * FROM ml",
    "quantile_breaks": "SELECT filter_key, metric, q, break_value FROM brk",
    "quantile_bins": "SELECT filter_key, metric, method, position, min, max, label, color, pattern FROM bins",
    "legend": f"""SELECT filter_key, metric, method, position, label, color FROM bins
        UNION ALL SELECT filter_key, metric, any_value(method), CAST(max(position) + 1 AS INTEGER),
            'No data in this release', '{NO_DATA_COLOR}' FROM bins GROUP BY filter_key, metric""",
    "country_bins": "SELECT * FROM cb",
    "map_country_join": f"""WITH shapes AS (SELECT ({_CODES})[n_nationkey + 1] AS iso FROM nation),
        figures AS (SELECT * FROM cb WHERE filter_key = 'all' AND metric = 'creators')
        SELECT coalesce(iso, country) AS country, value, CASE WHEN iso IS NULL THEN 'not_on_map'
            WHEN country IS NULL THEN 'no_data' ELSE 'mapped' END AS status, coalesce(color, '{NO_DATA_COLOR}') AS color
        FROM shapes FULL JOIN figures ON iso = country""",
    "country_sorted": " UNION ALL ".join(
        f"""SELECT filter_key, country, country_name, '{key}' AS sort_key, '{d}' AS direction,
            CAST(row_number() OVER (PARTITION BY filter_key ORDER BY {col} {d}, country) AS INTEGER) AS place
            FROM cs JOIN names USING (country)"""
        for key, col in (
            ("country", "country_name"), ("creators", "creator_count"), ("videos", "represented_video_count"),
            ("occurrences", "source_occurrence_count"),
        )
        for d in ("asc", "desc")
    ),
    "creator_rows": """SELECT channel_key, display_name, cr.country, represented_video_count,
            (SELECT string_agg(dataset_id || ' (' || v || ')', ', ' ORDER BY dataset_id) FROM crd
             WHERE crd.channel_key = cr.channel_key) AS datasets_label, 'Jan 19, 2024' AS observed_label FROM cr""",
    "published_creators": f"""SELECT country, count(*) AS creators,
        count(*) FILTER (represented_video_count >= {fx.DISCLOSURE_THRESHOLD}) AS listed FROM cr GROUP BY country""",
    "removals_antijoin": "SELECT public_channel_key, display_name, country, represented_video_count FROM pub",
    "creator_rank": """SELECT country, rank, total_rows, public_channel_key, display_name FROM ranked
        WHERE sort_order = 'representedVideoCountDesc'""",
    "creator_rank_name": """SELECT country, rank, total_rows, public_channel_key, display_name FROM ranked
        WHERE sort_order = 'displayNameAsc'""",
    "creator_pages": f"""SELECT country, sort_order, page, rank, public_channel_key, represented_video_count,
        CASE WHEN (page + 1) * {fx.PAGE_SIZE} < total_rows THEN CAST(page + 1 AS VARCHAR) END AS next_cursor, total_rows
        FROM ranked""",
    "first_page": f"""SELECT country, rank, public_channel_key, represented_video_count FROM ranked
        WHERE sort_order = 'representedVideoCountDesc' AND rank <= {fx.PAGE_SIZE}""",
    "page_index": f"""SELECT country, sort_order, page_count, page, 'releases/{fx.RELEASE_ID}/creators/' || country ||
        '/' || sort_order || '/page-' || page || '.json' AS path FROM pages""",
    "page_fetch": f"""WITH req AS (SELECT event_id AS request_id, ({[*fx.NATION_CODES, 'XX']})[user_id % 26 + 1] AS country,
            CASE WHEN event_id % 10 = 9 THEN 'newest' WHEN event_id % 2 = 0 THEN 'displayNameAsc'
                ELSE 'representedVideoCountDesc' END AS sort_order, event_id % 7 - 1 AS page FROM events),
        pc AS (SELECT DISTINCT country, sort_order, page_count FROM pages)
        SELECT request_id, country, sort_order, page,
            CASE WHEN page >= 0 AND page < page_count THEN 'ok' ELSE 'not-found' END AS status,
            CASE WHEN page >= 0 AND page < page_count THEN 'releases/{fx.RELEASE_ID}/creators/' || country || '/' ||
                sort_order || '/page-' || page || '.json' END AS path,
            CASE WHEN page_count IS NULL THEN 'this release publishes no pages for the ' || sort_order || ' order'
                WHEN page < 0 OR page >= page_count THEN 'page ' || (page + 1) ||
                ' does not exist; this country has ' || page_count END AS message
        FROM req LEFT JOIN pc USING (country, sort_order)""",
    "page_content": f"""WITH req AS (SELECT event_id AS request_id, ({[*fx.NATION_CODES, 'XX']})[user_id % 26 + 1] AS country,
            CASE WHEN event_id % 10 = 9 THEN 'newest' WHEN event_id % 2 = 0 THEN 'displayNameAsc'
                ELSE 'representedVideoCountDesc' END AS sort_order, event_id % 7 - 1 AS page FROM events)
        SELECT request_id, country, sort_order, page, CASE WHEN rank IS NULL THEN 'not-found' ELSE 'ok' END AS status,
            CAST((rank - 1) % {fx.PAGE_SIZE} AS INTEGER) AS position, public_channel_key, represented_video_count,
            CASE WHEN (page + 1) * {fx.PAGE_SIZE} < total_rows THEN CAST(page + 1 AS VARCHAR) END AS next_cursor, total_rows
        FROM req LEFT JOIN ranked USING (country, sort_order, page)""",
    "filter_options": """SELECT CAST(position AS INTEGER) AS position, f.filter_key,
            CASE band WHEN 0 THEN 'All datasets' WHEN 1 THEN corpus_classes[1] || ' corpora' ELSE d.display_name END
                AS option_label,
            CASE WHEN len(f.datasets) = 1 THEN (SELECT x.version || ' · counts ' || lower(x.occurrence_unit) ||
                    CASE WHEN x.corpus_class = 'Comparison' THEN ' · comparison corpus' ELSE '' END
                    FROM ds x WHERE x.dataset_id = f.datasets[1])
                WHEN corpus_classes = ['Comparison'] THEN
                    'Labelled from its own documented provenance and licence terms'
                ELSE len(f.datasets) || ' datasets' END AS note
        FROM fl f LEFT JOIN ds d ON f.filter_key = d.dataset_id""",
    "filter_keys": """SELECT k AS selection_key, count(*) AS links, any_value(p.filter_key) AS published_filter FROM (
            SELECT array_to_string(corpus_classes, '+') || '~' || array_to_string(datasets, '+') AS k FROM sel)
        LEFT JOIN (SELECT filter_key, array_to_string(corpus_classes, '+') || '~' || array_to_string(datasets, '+')
            AS k FROM fl) p USING (k) GROUP BY k""",
    "filter_resolve": """SELECT array_to_string(datasets, '+') AS datasets,
        array_to_string(corpus_classes, '+') AS corpus_classes, filter_key, exact, count(*) AS links FROM rs
        GROUP BY ALL""",
    "release_summary": f"""SELECT array_to_string(datasets, '+') AS selection, filter_key, exact, links,
            'Showing ' || CASE WHEN len(datasets) IN (0, 6) THEN 'all 6 datasets' ELSE len(datasets) ||
                ' of 6 datasets' END || ', across ' || country_bucket_count || ' country bucket' ||
                CASE WHEN country_bucket_count = 1 THEN '' ELSE 's' END || '.' AS scope_line,
            'Showing ' || CASE WHEN len(datasets) = 0 THEN 'all 6 datasets' ELSE
                array_to_string(datasets, ' and ') END || '. ' || format('{{:,}}', creator_count) || ' creators, ' ||
                format('{{:,}}', represented_video_count) || ' represented videos, across ' ||
                format('{{:,}}', country_bucket_count) || ' country ' || CASE WHEN country_bucket_count = 1 THEN
                'bucket' ELSE 'buckets' END || '.' || CASE WHEN exact THEN '' ELSE '{_FALLBACK}' END AS announcement
        FROM (SELECT datasets, filter_key, exact, count(*) AS links FROM rs GROUP BY ALL) JOIN head USING (filter_key)""",
    "country_missing": f"""WITH req AS (SELECT ({[*fx.NATION_CODES, 'XX']})[user_id % 26 + 1] AS country,
            (['all', 'candidate', 'comparison', 'ds-af', 'ds-ao', 'ds-nf', 'ds-no', 'ds-rf', 'ds-ro'])[event_id % 9 + 1]
            AS filter_key FROM events)
        SELECT filter_key, country, count(*) AS requests, country || ' is not in the current filter' AS note
        FROM req ANTI JOIN cs USING (filter_key, country) GROUP BY filter_key, country""",
    "selection_parse": f"""SELECT {_SELECTION_COLUMNS}, CAST(coalesce(n, 0) AS INTEGER) AS corrections,
            coalesce(n, 0) > 0 AS used_fallback
        FROM sel LEFT JOIN (SELECT event_id, count(*) AS n FROM corr GROUP BY event_id) USING (event_id)""",
    "selection_corrections": """SELECT field, rejected, reason, count(*) AS links FROM corr GROUP BY ALL""",
    "selection_releases": f"""SELECT field, rejected, reason, count(*) AS links FROM (
            SELECT event_id, field, rejected, reason FROM corr
            UNION ALL SELECT event_id, 'release', '{fx.RELEASE_ID}', 'release is not available' FROM events WHERE event_id % 7 = 0
            UNION ALL SELECT event_id, 'corpusClasses', 'Comparison', 'unknown corpus class' FROM events WHERE user_id % 4 = 1)
        GROUP BY ALL""",
    "selection_canonical": """SELECT CASE WHEN q = '' THEN '/' ELSE '/?' || q END AS canonical, count(*) AS links FROM (
            SELECT concat_ws('&', 'release=' || release,
                CASE WHEN len(datasets) > 0 THEN 'datasets=' || array_to_string(datasets, ',') END,
                CASE WHEN len(corpus_classes) > 0 THEN 'corpus=' || array_to_string(corpus_classes, ',') END,
                'country=' || country, CASE WHEN metric <> 'creators' THEN 'metric=' || metric END,
                CASE WHEN view <> 'map' THEN 'view=' || view END,
                CASE WHEN country IS NOT NULL AND sort <> 'representedVideoCountDesc' THEN 'sort=' || sort END,
                CASE WHEN country IS NOT NULL THEN 'cursor=' || cursor END) AS q FROM sel)
        GROUP BY 1""",
    "overview_json": "SELECT path, body FROM ovj",
    "country_shard": "SELECT path, body FROM shj",
    "manifest_digests": "SELECT path, 'sha256:' || sha256(body) AS digest FROM docs",
    "release_leaks": f"""WITH planted AS (SELECT path, CASE WHEN {_hex_digit('path')} = 6
                THEN body || ' {fx.PLANTED_ID} x{fx.PLANTED_ID} {fx.PLANTED_ID}' ELSE body END AS body FROM docs),
        raw AS (SELECT DISTINCT video_id AS token FROM (SELECT CASE WHEN l_orderkey % 97 <> 0 THEN
            'V' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') END AS video_id FROM lineitem
            UNION ALL SELECT CASE WHEN o_orderkey % 97 <> 0 THEN 'V' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') END FROM orders))
        SELECT 'video' AS kind, token, path, count(*) AS occurrences
        FROM (SELECT path, unnest(string_split_regex(body, '[^A-Za-z0-9_-]+')) AS token FROM planted) SEMI JOIN raw USING (token)
        GROUP BY token, path""",
    "release_audit": f"""WITH f AS (SELECT path, kind, {_hex_digit('path')} AS fault,
            regexp_extract(path, 'countries/(.*)[.]json', 1) AS country,
            {_hex_digit(f"'releases/{fx.RELEASE_ID}/overview.json'")} AS overview_fault FROM docs)
        SELECT path, kind, CASE WHEN fault IN (1, 2) THEN 'not-found' WHEN fault = 0 THEN 'digest-mismatch'
                WHEN fault = 3 THEN 'schema-invalid'
                WHEN fault = 4 THEN 'mixed-release'
                WHEN fault = 5 AND kind = 'shard' AND overview_fault > 4 THEN 'mixed-release' ELSE 'ok' END AS status,
            CASE WHEN fault = 2 THEN 'not listed' WHEN fault = 1 THEN 'absent' WHEN fault = 0 THEN 'digest mismatch'
                WHEN fault = 3 THEN 'Unrecognized key(s) in object: ''extra'''
                WHEN fault = 4 AND kind = 'overview' THEN 'the filtered overview belongs to a different release'
                WHEN fault = 4 AND kind = 'shard' THEN 'shard for ' || country || ' reports country QQ'
                WHEN fault = 4 THEN 'the creator page does not match the requested country and sort order'
                WHEN fault = 5 AND kind = 'shard' AND overview_fault > 4 THEN
                    'the country detail disagrees with the overview totals' END AS detail
        FROM f
        UNION ALL SELECT 'active-release.json', 'pointer', 'ok', NULL
        UNION ALL SELECT 'releases/{fx.RELEASE_ID}/manifest.json', 'manifest', 'ok', NULL""",
    "shard_reconcile": f"""SELECT k.filter_key, s.country, CASE WHEN o.country IS NULL THEN 'not-in-filter'
            WHEN {_hex_digit(f"'releases/{fx.RELEASE_ID}/countries/' || s.country || '.json'")} = 5 THEN 'mixed-release'
            WHEN o.creator_count = s.creator_count AND o.represented_video_count = s.represented_video_count THEN 'ok'
            ELSE 'mixed-release' END AS status
        FROM keys k CROSS JOIN (SELECT * FROM cs WHERE filter_key = 'all') s
        LEFT JOIN cs o ON o.filter_key = k.filter_key AND o.country = s.country""",
    "validate_fields": """SELECT path, rule, message, count(*) AS documents FROM (SELECT c_custkey % 10 AS k FROM customer)
        JOIN (VALUES
            (0, 'representedVideoCount', 'too_small', 'Number must be greater than or equal to 0'),
            (1, 'representedVideoCount', 'invalid_type', 'Expected number, received string'),
            (2, 'displayName', 'invalid_type', 'Required'),
            (3, 'displayName', 'too_small', 'String must contain at least 1 character(s)'),
            (4, 'lastObservedAt', 'invalid_string', 'must be YYYY-MM-DD'),
            (5, 'publicChannelKey', 'invalid_string', 'public channel key must be pk_-prefixed'),
            (6, 'datasetBreakdown.0.datasetId', 'too_small', 'String must contain at least 1 character(s)'),
            (7, 'country', 'invalid_string', 'country must be ISO 3166 alpha-2 uppercase'),
            (8, 'representedVideoCount', 'invalid_type', 'Expected integer, received float')
        ) t(k, path, rule, message) USING (k) GROUP BY ALL""",
    "validate_keys": """SELECT 'publicChannelKey' AS path, rule, message, count(*) AS documents
        FROM (SELECT c_custkey % 8 AS k FROM customer) JOIN (VALUES
            (0, 'custom', 'public channel key must not embed a raw YouTube channel ID'),
            (1, 'custom', 'public channel key must not embed a raw YouTube channel ID'),
            (2, 'invalid_string', 'public channel key must be pk_-prefixed'),
            (3, 'invalid_string', 'public channel key must be pk_-prefixed')) t(k, rule, message) USING (k)
        GROUP BY ALL""",
    "validate_strict": """SELECT path, 'unrecognized_keys' AS rule, message, count(*) AS documents FROM (
            SELECT '' AS path, 'Unrecognized key(s) in object: ''by'', ''note''' AS message
                FROM (SELECT DISTINCT channel_key FROM res) WHERE channel_key % 3 = 0
            UNION ALL SELECT 'partition', 'Unrecognized key(s) in object: ''deleted'''
                FROM (SELECT DISTINCT channel_key FROM res) WHERE channel_key % 4 = 0) GROUP BY ALL""",
    "validate_coverage": """SELECT channel_key, 'partition' AS path, 'custom' AS rule,
            'resolution partition sums to ' || count(*) || ', expected ' || (count(*) + 1) AS message
            FROM res GROUP BY channel_key HAVING channel_key % 7 = 0
        UNION ALL SELECT DISTINCT channel_key, 'resolvedChannelCount', 'custom', 'known + unknown channels = 1, expected 3'
            FROM res WHERE channel_key % 11 = 0""",
    "validate_filters": """WITH e AS (SELECT event_id % 5 AS d, event_id % 3 AS c FROM events)
        SELECT path, rule, message, count(*) AS documents FROM (
            SELECT 'datasets' AS path, 'custom' AS rule, 'datasets must be sorted' AS message FROM e
                WHERE c <> 2 AND d IN (1, 4)
            UNION ALL SELECT 'datasets', 'custom', 'datasets must be unique' FROM e WHERE c <> 2 AND d = 2
            UNION ALL SELECT 'datasets', 'too_small', 'Array must contain at least 1 element(s)' FROM e WHERE d = 3
            UNION ALL SELECT 'datasets.1', 'too_small', 'String must contain at least 1 character(s)' FROM e WHERE d = 4
            UNION ALL SELECT 'corpusClasses', 'custom', 'corpusClasses must be sorted' FROM e WHERE c = 1
            UNION ALL SELECT 'corpusClasses.0', 'invalid_enum_value',
                'Invalid enum value. Expected ''Candidate'' | ''Comparison'', received ''Other''' FROM e WHERE c = 2)
        GROUP BY ALL""",
    "validate_countries": """SELECT document_id, 'countries' AS path, 'custom' AS rule,
            'duplicate country bucket: ' || country AS message, count(*) - 1 AS repeats
        FROM (SELECT channel_key // 30 AS document_id, country FROM ch) GROUP BY document_id, country
        HAVING count(*) > 1""",
    "validate_manifest": """SELECT event_id, 'enrichmentCutoff' AS path, 'invalid_string' AS rule,
            'Invalid datetime' AS message FROM events WHERE event_id % 7 = 0
        UNION ALL SELECT event_id, 'enrichmentCutoff', 'custom',
            'enrichmentCutoff must not be later than generatedAt' FROM events WHERE event_id % 5 > 2""",
}

ORACLES = {name: _with(f"SELECT * FROM ({body})") for name, body in _BODIES.items()}
