"""The SQL check of every registered query, in DuckDB's dialect.

Rules and reports are stated directly over single readings and notes (look-ups
per patient and device, ``COUNT(DISTINCT)``), without the pre-aggregates the
Spark jobs use, so that those are checked too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pulseledger.catalogue import queries as q
from pulseledger.catalogue.domain import (
    AS_OF,
    DASHBOARD_TIME,
    LOADED_AT,
    REPORT_END,
    REPORT_START,
    TARGET_MAPPINGS,
    table_sql,
)
from pulseledger.functions import vocabulary as words
from pulseledger.operators.entities import (
    ADDRESS_COLUMNS,
    INSURANCE_COLUMNS,
    LOADER,
    PATIENT_COLUMNS,
)
from pulseledger.schemas import PATIENT_EXPORT_COLUMNS, target_columns

ORACLE: dict[str, str] = {}


def _with(ctes: Iterable[tuple[str, str]], body: str) -> str:
    named: dict[str, str] = {}
    for name, text in ctes:
        named.setdefault(name, text)
    clauses = ",\n".join(f"{name} AS ({text})" for name, text in named.items())
    return f"WITH {clauses}\n{body}"


def _tables(*names: str) -> list[tuple[str, str]]:
    return [("coach" if name == "user" else name, table_sql(name)) for name in names]


# --- billing codes ------------------------------------------------------------------

_RULE_TABLES = ("device", "glucose_reading", "blood_pressure_reading", "patient_note", "note_type")


def reading(pressure: str = "blood_pressure_reading") -> tuple[str, str]:
    """CTE of the readings of known devices, both kinds."""
    kinds = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, device_id, received_datetime AS read_at FROM {table}"
        for kind, table in (("glucose", "glucose_reading"), ("pressure", pressure))
    )
    return (
        "reading",
        f"SELECT kind, device_id, patient_id, read_at, CAST(read_at AS DATE) AS day "
        f"FROM ({kinds}) JOIN device USING (device_id)",
    )


def _usage_start(as_of: str) -> str:
    return f"(DATE '{as_of}' - 30)"


def _talk_start(as_of: str) -> str:
    return f"CAST(DATE '{as_of}' - INTERVAL 1 MONTH AS DATE)"


def _first_visit(codes: str, links: str, as_of: str) -> str:
    return f"""
    SELECT patient_id, '99202' AS code, max(note_datetime) AS timestamp_applied
    FROM patient_note
    WHERE note_type_id = (SELECT note_type_id FROM note_type WHERE name = 'Initial Evaluation')
    AND patient_id NOT IN (SELECT patient_id FROM {codes} WHERE code BETWEEN '99202' AND '99205')
    GROUP BY patient_id HAVING sum(call_time_seconds) BETWEEN 900 AND 1799"""


def _sixteen_days(code: str, condition: str) -> str:
    return f"""
    SELECT patient_id, '{code}' AS code, max(read_at) AS timestamp_applied
    FROM reading WHERE {condition}
    GROUP BY patient_id HAVING count(DISTINCT day) >= 16"""


def _setup(kind: str):
    def rule(codes: str, links: str, as_of: str) -> str:
        fresh = f"(patient_id, device_id) NOT IN (SELECT (patient_id, device_id) FROM {links} WHERE code = '99453')"
        return _sixteen_days("99453", f"kind = '{kind}' AND {fresh}")

    return rule


def _not_recently_used(codes: str, as_of: str) -> str:
    since = _usage_start(as_of)
    return (
        f"day >= {since} AND patient_id NOT IN (SELECT patient_id FROM {codes} "
        f"WHERE code = '99454' AND timestamp_applied >= {since})"
    )


def _usage(kind: str):
    def rule(codes: str, links: str, as_of: str) -> str:
        return _sixteen_days("99454", f"kind = '{kind}' AND {_not_recently_used(codes, as_of)}")

    return rule


def _combined_usage(codes: str, links: str, as_of: str) -> str:
    return f"""
    SELECT patient_id, '99454' AS code,
        if(glucose_last > pressure_last, glucose_last, pressure_last) AS timestamp_applied
    FROM (
        SELECT patient_id,
            max(read_at) FILTER (kind = 'glucose') AS glucose_last,
            max(read_at) FILTER (kind = 'pressure') AS pressure_last,
            count(DISTINCT day) FILTER (kind = 'glucose') AS glucose_days,
            count(DISTINCT day) FILTER (kind = 'pressure') AS pressure_days
        FROM reading WHERE {_not_recently_used(codes, as_of)} GROUP BY patient_id)
    WHERE greatest(glucose_days, pressure_days) >= 16"""


def _first_talk(codes: str, links: str, as_of: str) -> str:
    since = _talk_start(as_of)
    return f"""
    SELECT patient_id, '99457' AS code, max(note_datetime) AS timestamp_applied
    FROM patient_note
    WHERE note_datetime >= {since} AND patient_id NOT IN (
        SELECT patient_id FROM {codes} WHERE code = '99457' AND timestamp_applied >= {since})
    GROUP BY patient_id HAVING sum(call_time_seconds) >= 1200"""


def _extra_talk_rows(codes: str, as_of: str) -> str:
    since = _talk_start(as_of)
    return f"""
    SELECT patient_id, blocks AS rpm_20_mins_blocks, had AS code_count, last_note,
        unnest(range(greatest(blocks - had - 1, 0))) AS number
    FROM (
        SELECT patient_id,
            CAST(least(sum(call_time_seconds) FILTER (note_datetime >= {since}) // 1200, 4) AS BIGINT) AS blocks,
            max(note_datetime) AS last_note
        FROM patient_note GROUP BY patient_id)
    JOIN (
        SELECT patient_id, count(*) FILTER (code = '99458') AS had
        FROM {codes} WHERE timestamp_applied >= {since} GROUP BY patient_id)
    USING (patient_id)"""


def _extra_talk(codes: str, links: str, as_of: str) -> str:
    return f"""
    SELECT patient_id, '99458' AS code, last_note AS timestamp_applied
    FROM ({_extra_talk_rows(codes, as_of)})"""


_RUN = (
    ("first_visit", _first_visit, False),
    ("glucose_setup", _setup("glucose"), True),
    ("pressure_setup", _setup("pressure"), True),
    ("glucose_usage", _usage("glucose"), False),
    ("pressure_usage", _usage("pressure"), False),
    ("first_talk", _first_talk, False),
    ("extra_talk", _extra_talk, False),
)

_NO_CODES = (
    "SELECT CAST(NULL AS BIGINT) AS patient_id, CAST(NULL AS VARCHAR) AS code, "
    "CAST(NULL AS TIMESTAMP) AS timestamp_applied WHERE false"
)
_NO_LINKS = (
    "SELECT CAST(NULL AS BIGINT) AS patient_id, CAST(NULL AS VARCHAR) AS code, "
    "CAST(NULL AS BIGINT) AS device_id WHERE false"
)


def _fold(as_of: str, upto: int = len(_RUN), prefix: str = "", codes: str = "no_codes",
          links: str = "no_links") -> tuple[list[tuple[str, str]], str, str]:
    """CTEs of a run; the names of its last code and link relations."""
    ctes = [("no_codes", _NO_CODES), ("no_links", _NO_LINKS)]
    for name, rule, linked in _RUN[:upto]:
        new, after, after_links = f"{prefix}{name}", f"{prefix}{name}_codes", f"{prefix}{name}_links"
        ctes.append((new, rule(codes, links, as_of)))
        ctes.append((after, f"SELECT * FROM {codes} UNION ALL SELECT * FROM {new}"))
        if linked:
            ctes.append(
                (
                    after_links,
                    f"SELECT * FROM {links} UNION ALL SELECT n.patient_id, n.code, d.device_id "
                    f"FROM {new} n JOIN device d ON n.patient_id = d.patient_id",
                )
            )
            links = after_links
        codes = after
    return ctes, codes, links


def _add_codes() -> None:
    base = [*_tables(*_RULE_TABLES), reading()]
    empty = [("no_codes", _NO_CODES), ("no_links", _NO_LINKS)]

    def alone(rule) -> str:
        return _with(base + empty, rule("no_codes", "no_links", AS_OF))

    def step(name: str, upto: int) -> str:
        ctes, _, _ = _fold(AS_OF, upto)
        return _with(base + ctes, f"SELECT * FROM {name}")

    ORACLE["code_99202"] = alone(_first_visit)
    ORACLE["code_99453_glucose"] = alone(_setup("glucose"))
    ORACLE["code_99453_bp"] = step("pressure_setup", 3)
    ORACLE["code_99454_glucose"] = alone(_usage("glucose"))
    ORACLE["code_99454_bp"] = step("pressure_usage", 5)
    ORACLE["code_99454_combined"] = alone(_combined_usage)
    ORACLE["code_99457"] = alone(_first_talk)
    ORACLE["code_99458"] = step("extra_talk", 7)
    ctes, codes, _ = _fold(AS_OF, 6)
    ORACLE["preview_99458"] = _with(
        base + ctes,
        f"SELECT patient_id, rpm_20_mins_blocks, code_count FROM ({_extra_talk_rows(codes, AS_OF)}) "
        "ORDER BY patient_id",
    )
    ctes, codes, links = _fold(AS_OF)
    ORACLE["billing_fold"] = _with(base + ctes, f"SELECT * FROM {codes}")
    ORACLE["code_device_links"] = _with(base + ctes, f"SELECT * FROM {links}")
    ORACLE["stored_code_ids"] = _with(
        base + ctes + _tables("medical_code_type"),
        f"""
        SELECT c.patient_id, t.med_code_type_id, c.timestamp_applied,
            CASE WHEN c.code = '99453' THEN (
                SELECT count(*) FROM device d WHERE d.patient_id = c.patient_id) ELSE 0 END
            AS linked_devices
        FROM {codes} c JOIN medical_code_type t ON t.name = c.code""",
    )
    first, codes, links = _fold(q.FIRST_RUN, prefix="early_")
    seen = [
        ("seen_reading", f"SELECT * FROM reading WHERE read_at < TIMESTAMP '{q.FIRST_RUN}'"),
        ("seen_note", f"SELECT * FROM patient_note WHERE note_datetime < TIMESTAMP '{q.FIRST_RUN}'"),
    ]
    first = seen + [
        (name, text.replace("FROM reading", "FROM seen_reading").replace("FROM patient_note", "FROM seen_note"))
        for name, text in first
    ]
    second, _, _ = _fold(AS_OF, prefix="late_", codes=codes, links=links)
    added = " UNION ALL ".join(f"SELECT * FROM late_{name}" for name, _, _ in _RUN)
    ORACLE["billing_fold_second_run"] = _with(base + first + second, added)


# --- reports ----------------------------------------------------------------------------

_REPORT_CODES = ("99202", "99453", "99454", "99457", "99458")
# Report column -> patient, address or insurance column.
_REPORT_COLUMNS = {
    "ID": "sharepoint_id",
    "FirstName": "first_name",
    "MiddleName": "middle_name",
    "LastName": "last_name",
    "Suffix": "name_suffix",
    "DOB": "date_of_birth",
    "PhoneNumber": "phone_number",
    "Address": "street_address",
    "City": "city",
    "State": "temp_state",
    "Zipcode": "zipcode",
    "Gender": "sex",
    "MedicareNumber": "medicare_beneficiary_id",
    "PrimaryPayer": "primary_payer_name",
    "PrimaryPayerID": "primary_payer_id",
    "SecondaryPayer": "secondary_payer_name",
    "SecondaryPayerID": "secondary_payer_id",
}


def _diagnoses(patient: str, separator: str, only: str = "TRUE") -> str:
    return (
        f"(SELECT string_agg(temp_dx_code, '{separator}' ORDER BY temp_dx_code) FROM medical_necessity m "
        f"WHERE m.patient_id = {patient}.patient_id AND {only})"
    )


def _report_sql(codes: str, start: str, end: str) -> str:
    counts = ", ".join(f"count(*) FILTER (code = '{code}') AS \"{code}\"" for code in _REPORT_CODES)
    shown = ", ".join(f'{column} AS "{title}"' for title, column in _REPORT_COLUMNS.items())
    given = ", ".join(f'served."{code}"' for code in _REPORT_CODES)
    return f"""
    SELECT served.day AS "DateOfService", {shown}, {_diagnoses("served", ", ")} AS "DXCodes", {given}
    FROM (
        SELECT patient_id, CAST(timestamp_applied AS DATE) AS day, {counts} FROM {codes}
        WHERE timestamp_applied BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY ALL
    ) served
    JOIN patient USING (patient_id)
    JOIN patient_address USING (patient_id)
    JOIN patient_insurance USING (patient_id)
    WHERE served.patient_id IN (SELECT patient_id FROM medical_necessity)"""


def month_columns(now: str) -> dict[str, str]:
    """Dashboard values of patient ``c`` and device ``d``, each looked up by itself."""
    span = f"BETWEEN date_trunc('month', TIMESTAMP '{now}') AND TIMESTAMP '{now}'"
    noted = f"FROM patient_note n WHERE n.patient_id = c.patient_id AND n.note_datetime {span}"
    return {
        "mon_min": f"(SELECT CAST(coalesce(sum(n.call_time_seconds), 0) // 60 AS BIGINT) {noted})",
        "last_note_date": f"(SELECT max(n.note_datetime) {noted})",
        "mon_count": "(SELECT count(DISTINCT (r.kind, r.day)) FROM reading r "
        f"WHERE r.device_id = d.device_id AND r.read_at {span})",
        "last_reading_date": "(SELECT max(r.read_at) FROM reading r WHERE r.device_id = d.device_id)",
    }


def board_sql(where: str, distinct: bool, now: str) -> str:
    values = ", ".join(f"{text} AS {name}" for name, text in month_columns(now).items())
    return f"""
    SELECT {"DISTINCT" if distinct else ""} c.patient_id, c.first_name, c.last_name,
        s.temp_status_type, a.temp_state, {values}
    FROM patient c LEFT JOIN device d ON d.patient_id = c.patient_id
    JOIN patient_status s ON s.patient_id = c.patient_id
    JOIN patient_address a ON a.patient_id = c.patient_id
    WHERE {where}"""


_BOARD_TABLES = ("patient", "user", "patient_status", "patient_address", "patient_note", "device",
                 "glucose_reading", "blood_pressure_reading")


def _board_sql(where: str, distinct: bool) -> str:
    ctes = [*_tables(*_BOARD_TABLES), reading()]
    return _with(ctes, board_sql(where, distinct, DASHBOARD_TIME))


def study_sql(now: str) -> str:
    since = f"(TIMESTAMP '{now}' - INTERVAL 30 DAY)"
    e119 = "temp_dx_code = 'E119'"
    return f"""
    SELECT c.patient_id, c.first_name, c.last_name, c.date_of_birth, c.sex, c.phone_number, a.temp_state,
        i.medicare_beneficiary_id, {_diagnoses("c", ",", e119)} AS dx_codes, gr_count, bpr_count
    FROM patient c
    JOIN patient_address a ON a.patient_id = c.patient_id
    JOIN patient_insurance i ON i.patient_id = c.patient_id
    JOIN (
        SELECT patient_id, count(DISTINCT day) FILTER (kind = 'glucose') AS gr_count,
            count(DISTINCT day) FILTER (kind = 'pressure') AS bpr_count
        FROM reading r
        WHERE r.read_at >= {since} OR EXISTS (
            SELECT 1 FROM reading o
            WHERE o.device_id = r.device_id AND o.kind <> r.kind AND o.read_at >= {since})
        GROUP BY patient_id
    ) days ON days.patient_id = c.patient_id
    WHERE greatest(gr_count, bpr_count) >= 16
    AND c.patient_id IN (SELECT patient_id FROM medical_necessity WHERE {e119})"""


def _study(pressure: str) -> str:
    ctes = _tables("patient", "patient_address", "patient_insurance", "medical_necessity", "device",
                   "glucose_reading", pressure)
    return _with([*ctes, reading(pressure)], study_sql(f"{AS_OF} 12:00:00"))


def _add_reports() -> None:
    ctes, codes, _ = _fold(AS_OF)
    base = [
        *_tables(*_RULE_TABLES, "patient", "patient_address", "patient_insurance", "medical_necessity"),
        reading(),
    ]
    ORACLE["billing_report"] = _with(
        base + ctes, _report_sql(codes, REPORT_START, REPORT_END) + " ORDER BY served.patient_id"
    )
    ORACLE["billing_report_open"] = _with(base + ctes, _report_sql(codes, q.OPEN_REPORT_START, AS_OF))
    coached = f"c.user_id IN (SELECT user_id FROM coach WHERE display_name = '{q.COACH}')"
    ORACLE["coach_queue"] = _board_sql(coached, True)
    ORACLE["coach_queue_raw"] = _board_sql(coached, False)
    ORACLE["patient_search"] = _board_sql("c.first_name = 'Cleo' AND c.last_name = 'Smith'", True)
    ORACLE["patient_search_any_case"] = _board_sql("lower(c.last_name) = 'o''brien'", True)
    ORACLE["patient_search_all"] = _board_sql("TRUE", True)
    ORACLE["patient_search_phone"] = _board_sql(f"c.phone_number = '{q.LONG_PHONE}'", True)
    ORACLE["patient_search_id"] = _board_sql(f"c.patient_id = {q.ONE_PATIENT}", True)
    month = month_columns(DASHBOARD_TIME)
    ORACLE["patient_overview"] = _with(
        [*_tables(*_BOARD_TABLES), reading()],
        f"""
        SELECT DISTINCT c.patient_id, c.full_name, a.temp_state, c.phone_number, c.date_of_birth,
            CAST(date_sub('year', c.date_of_birth, TIMESTAMP '{DASHBOARD_TIME}') AS INTEGER) AS age,
            s.temp_status_type, {month["mon_min"]} AS mon_min, {month["mon_count"]} AS mon_count,
            (SELECT count(*) FROM device o WHERE o.patient_id = c.patient_id) AS owned_devices
        FROM patient c JOIN device d ON d.patient_id = c.patient_id
        JOIN patient_status s ON s.patient_id = c.patient_id
        JOIN patient_address a ON a.patient_id = c.patient_id""",
    )
    ORACLE["patient_overview_one"] = f"{ORACLE['patient_overview']} WHERE c.patient_id = {q.ONE_PATIENT}"
    ORACLE["study_extract"] = _study("blood_pressure_reading")
    ORACLE["study_extract_shared_devices"] = _study("pressure_on_same_device")
    ORACLE["latest_reading"] = _with(
        _tables("glucose_reading", "blood_pressure_reading"),
        """SELECT device_id, max(received_datetime) AS last_reading_date FROM (
        SELECT device_id, received_datetime FROM glucose_reading
        UNION ALL SELECT device_id, received_datetime FROM blood_pressure_reading) GROUP BY device_id""",
    )
    ORACLE["month_minutes"] = _with(
        _tables("patient", "patient_note"),
        f"SELECT c.patient_id, {month['mon_min']} AS mon_min, {month['last_note_date']} AS last_note_date "
        "FROM patient c",
    )
    ORACLE["owned_devices"] = _with(
        _tables("device"),
        "SELECT patient_id, count(device_id) AS owned_devices FROM device GROUP BY patient_id",
    )
    ORACLE["billing_cycle_filter"] = """
        WITH cycles AS (
            SELECT o_custkey,
                CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH AS DATE) AS cycle_start,
                CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 1 DAY AS DATE) AS cycle_end
            FROM orders GROUP BY o_custkey)
        SELECT o.o_orderkey, c.cycle_start, c.cycle_end
        FROM orders o JOIN cycles c ON o.o_custkey = c.o_custkey
        WHERE o.o_orderdate >= c.cycle_start AND o.o_orderdate <= c.cycle_end"""


# --- cleansing ------------------------------------------------------------------------------


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(substr(t, 1, 1)) || substr(t, 2)), '')"


def _title_trim(x: str) -> str:
    return _title(_trim(x))


def _name(x: str, drops: str) -> str:
    return rf"regexp_replace(regexp_replace({_title_trim(x)}, '\s+', ' ', 'g'), '{drops}', '', 'g')"


def _digits(x: str) -> str:
    return rf"coalesce(regexp_replace({x}, '\D', '', 'g'), '')"


def _alnum(x: str) -> str:
    return f"regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g')"


def _extract(x: str, pattern: str, fallback: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '{pattern}') THEN regexp_extract({x}, '{pattern}') "
        f"ELSE {fallback} END"
    )


def _word(x: str, word: str) -> str:
    return rf"regexp_matches(lower({x}), '\b{word}\b')"


def _chain(x: str, arms: Iterable[tuple[str, str]], fallback: str) -> str:
    body = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in arms)
    return f"CASE {body} ELSE {fallback} END"


def _keyword(x: str, pairs, fallback: str) -> str:
    return _chain(x, [(name, _word(x, phrase.lower())) for name, phrase in pairs], fallback)


def _keyword_sets(x: str, pairs, fallback: str) -> str:
    arms = [
        (name, " AND ".join(_word(x, word) for word in words_))
        for name, sets in pairs
        for words_ in sets
    ]
    return _chain(x, arms, fallback)


def _recode(x: str, pairs) -> str:
    arms = " ".join(f"WHEN {x} = '{old}' THEN '{new}'" for old, new in pairs)
    return f"CASE {arms} ELSE {x} END"


def _null_text(x: str, pattern: str = "(?i)^nan$") -> str:
    return f"CASE WHEN NOT regexp_matches({x}, '{pattern}') THEN {x} END"


def _parsed(x: str) -> str:
    return f"coalesce(try_strptime({x}, '%m/%d/%Y'), try_strptime({x}, '%Y-%m-%d'))"


_PERSON = r"[^a-zA-Z\s.-]"
_CLEAN: dict[str, str] = {
    "first_name": _name('"First Name"', _PERSON),
    "last_name": _name('"Last Name"', _PERSON),
    "middle_name": _name('"Middle Name"', r"[^a-zA-Z\s-]"),
    "name_suffix": _title_trim('"Suffix"'),
    "nick_name": _title_trim('"Nickname"'),
    "date_of_birth": _parsed('"DOB"'),
    "sex": _recode('"Gender"', words.SEXES),
    "email": _extract(
        _trim('lower("Email")'), r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$", "NULL"
    ),
    "phone_number": _digits('"Phone Number"'),
    "social_security": _digits('"Social Security"'),
    "temp_race": _keyword_sets(_title_trim('"Race"'), words.RACES, _title_trim('"Race"')),
    "temp_marital_status": '"Relationship_Status"',
    "preferred_language": '"Preferred_Language"',
    "weight_lbs": r"""CASE
        WHEN contains(lower("Weight"), '''') OR contains("Weight", '"')
            OR contains(lower("Weight"), 'ft') OR contains(lower("Weight"), 'in') THEN NULL
        ELSE coalesce(TRY_CAST(substr(regexp_replace("Weight", '\D', '', 'g'), 1, 3) AS BIGINT), 0) END""",
    "height_in": r"""CASE
        WHEN contains(lower("Height"), 'lbs') OR contains(lower("Height"), 'kg') THEN NULL
        WHEN regexp_matches(trim("Height"), '^(\d+)\D*?(\d+)?\D*?$') THEN
            CAST(regexp_extract(trim("Height"), '^(\d+)\D*?(\d+)?\D*?$', 1) AS BIGINT) * 12
            + coalesce(TRY_CAST(regexp_extract(trim("Height"), '^(\d+)\D*?(\d+)?\D*?$', 2) AS BIGINT), 0)
        END""",
    "sharepoint_id": 'CAST("ID" AS BIGINT)',
    "street_address": _name('"Mailing Address"', r"[^a-zA-Z0-9\s#.-/]"),
    "city": _name('"City"', "[^a-zA-Z-]"),
    "temp_state": f"""upper({_keyword(_title_trim('"State"'), words.STATES, _title_trim('"State"'))})""",
    "zipcode": """split_part("Zip code", '-', 1)""",
    "emergency_full_name": _name('"EmergencyName"', r"[^a-zA-Z\s.-/()]"),
    "emergency_phone_number": _digits('"EmergencyNumber"'),
    "emergency_relationship": _keyword('"EmergencyName"', words.RELATIONSHIPS, "NULL"),
    "emergency_full_name2": _name('"EmergencyName2"', r"[^a-zA-Z\s.-/()]"),
    "emergency_phone_number2": _digits('"EmergencyNumber2"'),
    "emergency_relationship2": _keyword('"EmergencyName2"', words.RELATIONSHIPS, "NULL"),
    "medicare_beneficiary_id": _extract(
        _alnum('"Medicare ID number"'), "[A-Z0-9]{11}", _alnum('"Medicare ID number"')
    ),
    "payer": _keyword_sets(
        _title_trim('"Insurance Name:"'), words.INSURERS, _title_trim('"Insurance Name:"')
    ),
    "payer_id": _extract(
        _alnum('"Insurance ID:"'), r"[A-Z]*\d+[A-Z]*\d+[A-Z]*\d+[A-Z]*\d*", _alnum('"Insurance ID:"')
    ),
    "secondary_payer_id": _extract(
        _alnum('"InsuranceID2"'), r"[A-Z]*\d+[A-Z]*\d+[A-Z]*\d+[A-Z]*\d*", _alnum('"InsuranceID2"')
    ),
    "secondary_payer_name": _keyword_sets(
        _title_trim('"InsuranceName2"'), words.INSURERS, _title_trim('"InsuranceName2"')
    ),
    "evaluation_datetime": _parsed('"On-board Date"'),
    "temp_dx_code": r"""coalesce(array_to_string(list_transform(
        regexp_extract_all(upper("DX_Code"), '[E|I|R]\d+(\.\d+)?'), lambda c: replace(c, '.', '')), ','), '')""",
    "temp_status_type": _recode('"Member_Status"', words.MEMBER_STATUSES),
    "temp_user": '"Health Coach"',
}
_UNTEXTED = {"date_of_birth", "evaluation_datetime", "weight_lbs", "height_in", "sharepoint_id"}


def _patients() -> list[tuple[str, str]]:
    """CTEs ending in ``cleansed``: the whole export cleansed."""
    step = ", ".join(f"{text} AS {name}" for name, text in _CLEAN.items())
    restored = ", ".join(
        name if name in _UNTEXTED else f"{_null_text(name)} AS {name}" for name in _CLEAN
    )
    return [
        *_tables("patient_export"),
        ("worded", f"SELECT {step} FROM patient_export"),
        (
            "named",
            "SELECT *, coalesce(first_name, 'Nan') || ' ' || coalesce(last_name, 'Nan') AS full_name "
            "FROM worded",
        ),
        ("restored", f"SELECT {restored}, full_name FROM named"),
        (
            "paid",
            """SELECT *, CASE WHEN payer IS NULL AND payer_id IS NULL
            AND medicare_beneficiary_id IS NOT NULL THEN 'Medicare Part B' ELSE payer END
            AS primary_payer_name FROM restored""",
        ),
        (
            "cleansed",
            """SELECT * EXCLUDE (payer, payer_id),
            CASE WHEN primary_payer_name = 'Medicare Part B' AND payer_id IS NULL
            THEN medicare_beneficiary_id ELSE payer_id END AS primary_payer_id FROM paid""",
        ),
    ]


_LIMITS = (
    ("phone_number", 11),
    ("social_security", 9),
    ("temp_state", 2),
    ("zipcode", 5),
    ("emergency_phone_number", 11),
    ("emergency_phone_number2", 11),
    ("medicare_beneficiary_id", 11),
    ("primary_payer_id", 30),
    ("secondary_payer_id", 30),
)
_FITS = " AND ".join(f"length(coalesce({name}, 'None')) <= {limit}" for name, limit in _LIMITS)

_DX_ROWS = (
    "SELECT evaluation_datetime, unnest(string_split(temp_dx_code, ',')) AS temp_dx_code, "
    "sharepoint_id FROM {source}"
)
_CONTACT_ROWS = """
    SELECT emergency_full_name AS full_name, emergency_phone_number AS phone_number,
        emergency_relationship AS relationship, sharepoint_id
    FROM {source} WHERE emergency_full_name IS NOT NULL AND emergency_phone_number IS NOT NULL
    UNION ALL
    SELECT emergency_full_name2, emergency_phone_number2, emergency_relationship2, sharepoint_id
    FROM {source} WHERE emergency_full_name2 IS NOT NULL AND emergency_phone_number2 IS NOT NULL"""


def _raw_columns(**columns: str) -> str:
    listed = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return _with(
        _tables("patient_export"),
        f'SELECT CAST("ID" AS BIGINT) AS sharepoint_id, {listed} FROM patient_export',
    )


_DURATION = r"^(?:(\d+) days? )?(\d+):(\d{2}):(\d{2})$"


def _seconds(x: str) -> str:
    def part(group: int) -> str:
        return f"coalesce(TRY_CAST(regexp_extract({x}, '{_DURATION}', {group}) AS DOUBLE), 0)"

    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' THEN 0.0::DOUBLE ELSE "
        f"{part(1)} * 86400 + {part(2)} * 3600 + {part(3)} * 60 + {part(4)} END"
    )


def _plain(x: str) -> str:
    return rf"regexp_replace({_unescaped(x)}, '<[^\n>]*>', '', 'g')"


def _unescaped(x: str) -> str:
    """The character references that occur in the given tables; the ampersand last."""
    text = x
    for reference, character in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">")):
        text = f"replace({text}, '&{reference};', '{character}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def _notes() -> list[tuple[str, str]]:
    """CTEs ending in ``merged`` and ``noted``."""
    text_null = "(?i)^na(n)?$"
    columns = {
        "sharepoint_id": '"SharePoint_ID"',
        "note_content": _plain('"Notes"'),
        "note_datetime": '"TimeStamp"',
        "temp_user": '"LCH_UPN"',
        "temp_note_type": f"""CASE WHEN "LCH_UPN" IN {words.ALERT_TEAM} THEN 'Alert'
            WHEN "LCH_UPN" IN {words.EVALUATORS} THEN 'Initial Evaluation'
            WHEN "Time_Note" = 'Initial Evaluation with APRN' THEN 'Initial Evaluation'
            ELSE split_part("Time_Note", ',', 1) END""",
        "call_time_seconds": """CAST(CASE WHEN "LCH_UPN" = 'NursePractitioner' THEN 900
            ELSE "Recording_Time" END AS BIGINT)""",
        "is_manual": 'CAST(NOT "Auto_Time" AS INTEGER)',
        "start_call_datetime": '"Start_Time"',
        "end_call_datetime": '"End_Time"',
    }
    step = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    texts = {"note_content", "temp_user", "temp_note_type"}
    restored = ", ".join(
        f"{_null_text(name, text_null)} AS {name}" if name in texts else name for name in columns
    )
    return [
        *_tables("notes_log", "time_log"),
        ("merged", _merged_sql("notes_log", "time_log")),
        ("noted", f"SELECT {restored} FROM (SELECT {step} FROM merged)"),
    ]


def _merged_sql(notes: str, log: str) -> str:
    return f"""
    SELECT n."SharePoint_ID", n."Notes", n."TimeStamp", n."LCH_UPN",
        coalesce(n."Time_Note", t."Notes") AS "Time_Note", t."Recording_Time", t."Auto_Time",
        t."Start_Time", t."End_Time"
    FROM {notes} n LEFT JOIN (
        SELECT * EXCLUDE ("Recording_Time"), {_seconds('"Recording_Time"')} AS "Recording_Time"
        FROM {log}
    ) t ON n."SharePoint_ID" IS NOT DISTINCT FROM t."SharPoint_ID"
    AND n."Note_ID" IS NOT DISTINCT FROM t."Note_ID" AND n."LCH_UPN" IS NOT DISTINCT FROM t."LCH_UPN\""""


def _reading_sql(source: str, values: dict[str, str]) -> str:
    rounded = ", ".join(
        f'round_even(CAST("{raw}" AS DOUBLE) * 100, 0) / 100 AS {name}' for name, raw in values.items()
    )
    return f"""
    SELECT "SharePoint_ID" AS sharepoint_id, "Device_Model" AS temp_device,
        "Time_Recorded" AS recorded_datetime, "Time_Recieved" AS received_datetime, {rounded},
        CAST("Manual_Reading" AS INTEGER) AS is_manual
    FROM {source}"""


_GLUCOSE_VALUES = {"glucose_reading": "BG_Reading"}
_PRESSURE_VALUES = {
    "systolic_reading": "BP_Reading_Systolic",
    "diastolic_reading": "BP_Reading_Diastolic",
}
_SUPPLIED = (
    'SELECT "Vendor", "Device_ID", "Device_Name", "Patient_ID" FROM fulfillment '
    """WHERE NOT "Resupply" AND "Vendor" IN ('Tenovi', 'Omron')"""
)
_DEVICE_ROWS = f"""
    SELECT CASE WHEN contains(coalesce("Device_Name", ''), "Vendor") THEN "Vendor"
        WHEN contains("Device_Name", 'Tenovi') THEN 'Tenovi' ELSE 'Omron' END AS "Vendor",
        replace("Device_ID", '-', '') AS hardware_uuid, "Device_Name" AS name,
        "Patient_ID" AS sharepoint_id
    FROM ({_SUPPLIED})"""


def _window(source: str, column: str, start: str, end: str) -> str:
    return (
        f"SELECT * FROM {source} WHERE \"{column}\" >= DATE '{start}' AND \"{column}\" <= DATE '{end}'"
    )


def _add_cleansing() -> None:
    def cleansed(columns: Iterable[str]) -> str:
        return _with(_patients(), f"SELECT {', '.join(columns)} FROM cleansed")

    c = _CLEAN
    ORACLE["clean_patients"] = _with(_patients(), "SELECT * FROM cleansed")
    ORACLE["clean_names"] = _raw_columns(
        first_name=c["first_name"],
        last_name=c["last_name"],
        full_name=f"coalesce({c['first_name']}, 'Nan') || ' ' || coalesce({c['last_name']}, 'Nan')",
        middle_name=c["middle_name"],
        nick_name=c["nick_name"],
        name_suffix=c["name_suffix"],
    )
    ORACLE["clean_states"] = _raw_columns(
        temp_state=c["temp_state"],
        city=c["city"],
        street_address=c["street_address"],
        zipcode=c["zipcode"],
    )
    ORACLE["clean_insurers"] = _raw_columns(payer=c["payer"], second_payer=c["secondary_payer_name"])
    ORACLE["clean_ids"] = _raw_columns(
        beneficiary_id=c["medicare_beneficiary_id"],
        payer_id=c["payer_id"],
        second_payer_id=c["secondary_payer_id"],
        email=c["email"],
        phone_number=c["phone_number"],
        social_security=c["social_security"],
    )
    ORACLE["clean_dx"] = _raw_columns(dx_codes=c["temp_dx_code"])
    ORACLE["clean_body"] = _raw_columns(
        weight_lbs=c["weight_lbs"],
        height_in=c["height_in"],
        race=c["temp_race"],
        sex=c["sex"],
        status=c["temp_status_type"],
    )
    ORACLE["clean_contacts"] = _raw_columns(
        contact=c["emergency_full_name"],
        relationship=c["emergency_relationship"],
        relationship2=c["emergency_relationship2"],
    )
    ORACLE["fill_payer"] = cleansed(["sharepoint_id", "primary_payer_name", "primary_payer_id"])
    ORACLE["parse_dates"] = _raw_columns(
        date_of_birth=c["date_of_birth"], evaluation_datetime=c["evaluation_datetime"]
    )
    ORACLE["clean_users"] = _with(
        _tables("directory"),
        """SELECT "givenName" AS first_name, surname AS last_name, "displayName" AS display_name,
        mail AS email, id AS ms_entra_id FROM directory""",
    )
    ORACLE["clean_devices"] = _with(_tables("fulfillment"), _DEVICE_ROWS)
    ORACLE["clean_glucose"] = _with(
        _tables("glucose_log"), _reading_sql("glucose_log", _GLUCOSE_VALUES)
    )
    ORACLE["clean_bp"] = _with(_tables("pressure_log"), _reading_sql("pressure_log", _PRESSURE_VALUES))
    ORACLE["merge_notes"] = _with(_notes(), "SELECT * FROM merged")
    ORACLE["clean_notes"] = _with(_notes(), "SELECT * FROM noted")
    ORACLE["note_texts"] = f"SELECT page_id, {_plain('html')} AS note_content FROM pages"

    for query, source, column in (
        ("scan_glucose", "glucose_log", "Time_Recorded"),
        ("scan_bp", "pressure_log", "Time_Recorded"),
        ("scan_notes", "notes_log", "TimeStamp"),
        ("scan_time_log", "time_log", "End_Time"),
    ):
        ORACLE[query] = _with(_tables(source), _window(source, column, q.SCAN_START, q.SCAN_END))
    ORACLE["scan_fulfillment"] = _with(_tables("fulfillment"), _SUPPLIED)

    ORACLE["split_patient"] = cleansed(PATIENT_COLUMNS)
    ORACLE["split_address"] = cleansed(ADDRESS_COLUMNS)
    ORACLE["split_insurance"] = cleansed(INSURANCE_COLUMNS)
    ORACLE["split_dx"] = _with(_patients(), _DX_ROWS.format(source="cleansed"))
    ORACLE["split_status"] = _with(
        _patients(),
        f"SELECT temp_status_type, sharepoint_id, TIMESTAMP '{LOADED_AT}' AS modified_date, "
        f"'{LOADER}' AS temp_user FROM cleansed",
    )
    ORACLE["split_contacts"] = _with(_patients(), _CONTACT_ROWS.format(source="cleansed"))
    ORACLE["constraint_pass"] = _with(_patients(), f"SELECT * FROM cleansed WHERE {_FITS}")
    _add_rejects()


def _add_rejects() -> None:
    def length(name: str) -> str:
        return f"length(coalesce({name}, 'None'))"

    rules = [
        ("phone number length error", f"{length('phone_number')} <> 11"),
        ("social security length error", f"{length('social_security')} <> 9"),
        ("zipcode length error", f"{length('zipcode')} <> 5"),
        ("emergency phone number length error", f"{length('emergency_phone_number')} <> 11"),
        ("second emergency phone number length error", f"{length('emergency_phone_number2')} <> 11"),
        ("medicare beneficiary id length error", f"{length('medicare_beneficiary_id')} <> 11"),
        ("primary payer id length error", f"{length('primary_payer_id')} >= 30"),
        ("secondary payer id length error", f"{length('secondary_payer_id')} >= 30"),
        ("missing insurance information", "primary_payer_id IS NULL AND primary_payer_name IS NULL"),
    ]
    columns = "sharepoint_id, first_name, last_name"
    parts = [
        f"SELECT '{error}' AS error_type, {columns} FROM cleansed WHERE {condition}"
        for error, condition in rules
    ]
    parts.append(
        f"SELECT 'duplicate patient', {columns} FROM (SELECT *, count(*) OVER "
        "(PARTITION BY first_name, last_name, date_of_birth) AS times FROM cleansed) WHERE times > 1"
    )
    ORACLE["rejects"] = _with(_patients(), " UNION ALL ".join(parts))


# --- keys -----------------------------------------------------------------------------------------


def _add_keys() -> None:
    ORACLE["resolve_keys"] = _with(
        _patients() + _tables("patient") + [("dx", _DX_ROWS.format(source="cleansed"))],
        """SELECT dx.evaluation_datetime, dx.temp_dx_code, p.patient_id
        FROM dx JOIN patient p ON dx.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id""",
    )
    ORACLE["resolve_status"] = _with(
        _patients() + _tables("patient"),
        f"""SELECT c.temp_status_type, TIMESTAMP '{LOADED_AT}' AS modified_date, '{LOADER}' AS temp_user, p.patient_id
        FROM cleansed c JOIN patient p ON c.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id""",
    )
    ORACLE["resolve_contacts"] = _with(
        _patients() + _tables("patient") + [("contact", _CONTACT_ROWS.format(source="cleansed"))],
        """SELECT k.* EXCLUDE (sharepoint_id), p.patient_id
        FROM contact k JOIN patient p ON k.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id""",
    )
    ORACLE["resolve_notes"] = _with(
        _notes() + _tables("patient"),
        """SELECT n.* EXCLUDE (sharepoint_id), p.patient_id
        FROM noted n JOIN patient p ON n.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id""",
    )
    ORACLE["resolve_devices"] = _with(
        _tables("fulfillment", "patient", "vendor") + [("devices", _DEVICE_ROWS)],
        """SELECT d.hardware_uuid, d.name, p.patient_id, v.vendor_id FROM devices d
        JOIN patient p ON d.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id
        JOIN vendor v ON d."Vendor" = v.name""",
    )
    ORACLE["resolve_readings"] = _with(
        _tables("glucose_log", "patient", "device")
        + [("readings", _reading_sql("glucose_log", _GLUCOSE_VALUES))],
        """SELECT r.* EXCLUDE (sharepoint_id), d.device_id FROM readings r
        JOIN patient p ON r.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id
        JOIN device d ON p.patient_id = d.patient_id""",
    )
    ORACLE["lookup_note_type"] = _with(
        _notes() + _tables("note_type"),
        """SELECT n.*, (SELECT t.note_type_id FROM note_type t WHERE t.name = n.temp_note_type)
        AS note_type_id FROM noted n""",
    )
    ORACLE["lookup_status_type"] = _with(
        _tables("patient_status", "patient_status_type"),
        """SELECT s.*, (SELECT t.patient_status_type_id FROM patient_status_type t
        WHERE t.name = s.temp_status_type) AS patient_status_type_id FROM patient_status s""",
    )
    ORACLE["lookup_coach"] = _with(
        _tables("patient", "user"),
        """SELECT p.patient_id, p.temp_user, (SELECT u.user_id FROM coach u
        WHERE u.display_name = p.temp_user) AS user_id FROM patient p""",
    )
    ORACLE["lookup_note_author"] = _with(
        _notes() + _tables("user"),
        """SELECT n.*, (SELECT u.user_id FROM coach u WHERE u.display_name = n.temp_user)
        AS user_id FROM noted n""",
    )
    ORACLE["surrogate_keys"] = _with(
        _patients() + _tables("patient"),
        f"""SELECT row_number() OVER (ORDER BY sharepoint_id)
            + (SELECT max(patient_id) FROM patient) AS patient_id, sharepoint_id, full_name
        FROM cleansed WHERE {_FITS}""",
    )


# --- the whole pipeline ----------------------------------------------------------------------------


def _add_pipeline() -> None:
    """Raw sources to report, ids by row number."""
    end = "2024-01-31"

    def by_patient(source: str, columns: str) -> str:
        return (
            f"SELECT {columns}, p.patient_id FROM {source} s "
            "JOIN patient p ON s.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id"
        )

    def window(source: str, column: str) -> str:
        return _window(source, column, "2024-01-01", end)

    def readings(name: str, values: dict[str, str]) -> str:
        return f"""SELECT r.received_datetime, d.device_id FROM ({_reading_sql(name, values)}) r
            JOIN patient p ON r.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id
            JOIN device d ON p.patient_id = d.patient_id"""

    notes = dict(_notes())
    fold, codes, _ = _fold(end)
    ctes = [
        *_patients(),
        ("accepted", f"SELECT * FROM cleansed WHERE {_FITS}"),
        (
            "patient",
            f"SELECT {', '.join(PATIENT_COLUMNS)}, row_number() OVER (ORDER BY sharepoint_id) AS patient_id "
            "FROM accepted",
        ),
        ("patient_address", by_patient("accepted", "s.street_address, s.city, s.temp_state, s.zipcode")),
        (
            "patient_insurance",
            by_patient(
                "accepted",
                "s.medicare_beneficiary_id, s.primary_payer_id, s.primary_payer_name, "
                "s.secondary_payer_id, s.secondary_payer_name",
            ),
        ),
        ("dx", _DX_ROWS.format(source="accepted")),
        ("medical_necessity", by_patient("dx", "s.temp_dx_code")),
        *_tables("fulfillment", "vendor", "note_type"),
        ("devices", _DEVICE_ROWS),
        (
            "device",
            """SELECT p.patient_id, row_number() OVER (ORDER BY p.patient_id, d.hardware_uuid)
                AS device_id FROM devices d
            JOIN patient p ON d.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id
            JOIN vendor v ON d."Vendor" = v.name""",
        ),
        ("all_glucose", table_sql("glucose_log")),
        ("all_pressure", table_sql("pressure_log")),
        ("glucose_log", window("all_glucose", "Time_Recorded")),
        ("pressure_log", window("all_pressure", "Time_Recorded")),
        ("glucose_reading", readings("glucose_log", _GLUCOSE_VALUES)),
        ("blood_pressure_reading", readings("pressure_log", _PRESSURE_VALUES)),
        reading(),
        ("all_notes", table_sql("notes_log")),
        ("all_times", table_sql("time_log")),
        ("notes_log", window("all_notes", "TimeStamp")),
        ("time_log", window("all_times", "End_Time")),
        ("merged", notes["merged"]),
        ("noted", notes["noted"]),
        (
            "patient_note",
            """SELECT n.* EXCLUDE (sharepoint_id), p.patient_id, t.note_type_id FROM noted n
            JOIN patient p ON n.sharepoint_id IS NOT DISTINCT FROM p.sharepoint_id
            LEFT JOIN note_type t ON t.name = n.temp_note_type""",
        ),
    ]
    ORACLE["load_and_bill"] = _with(ctes + fold, _report_sql(codes, "2024-01-01", end))


# --- files and stored tables -----------------------------------------------------------


def _stored(table: str, where: str = "TRUE") -> str:
    """A mapped table in the columns of its target table; absent ones are null."""
    given = TARGET_MAPPINGS[table].columns
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}
    columns = ", ".join(
        f"CAST({name if name in given else 'NULL'} AS {kinds[kind]}) AS {name}"
        for name, kind in target_columns(table).items()
    )
    return _with(_tables(table), f"SELECT {columns} FROM {table} WHERE {where}")


def _add_files() -> None:
    absent = ", ".join(f"'{text}'" for text in words.CSV_NULLS)
    cells = ", ".join(
        _parsed(f'"{name}"') + f' AS "{name}"'
        if name in ("DOB", "On-board Date")
        else f'CASE WHEN "{name}" NOT IN ({absent}) THEN "{name}" END AS "{name}"'
        for name in PATIENT_EXPORT_COLUMNS
    )
    ORACLE["export_csv"] = _with(_tables("patient_export"), f"SELECT {cells} FROM patient_export")
    ORACLE["directory_json"] = _with(_tables("directory"), "SELECT * FROM directory")
    ORACLE["append_twice"] = _stored("glucose_reading")
    ORACLE["reset_then_append"] = _stored(
        "patient_note",
        f"note_datetime >= TIMESTAMP '{q.SCAN_START}' AND note_datetime < TIMESTAMP '{q.FIRST_RUN}'",
    )
    ctes, codes, _ = _fold(AS_OF)
    base = [*_tables(*_RULE_TABLES), reading(), *ctes]
    ORACLE["replaced_codes"] = _with(
        base,
        f"SELECT patient_id, CAST(1 AS BIGINT) AS med_code_type_id, timestamp_applied FROM {codes} WHERE code = '99202'",
    )
    tables = _tables("patient", "patient_address", "patient_insurance", "medical_necessity")
    cells = ", ".join(f'CAST("{name}" AS VARCHAR) AS "{name}"' for name in ("ID", "DateOfService", *_REPORT_CODES))
    ORACLE["report_csv"] = _with(
        base + tables, f"SELECT {cells} FROM ({_report_sql(codes, REPORT_START, REPORT_END)})"
    )
    ORACLE["snapshots"] = ORACLE["split_patient"]


_add_codes()
_add_reports()
_add_cleansing()
_add_keys()
_add_pipeline()
_add_files()


# Stored summaries give what the readings and notes themselves give.
ORACLE |= {
    "billing_fold_stored": ORACLE["billing_fold"],
    "coach_queue_stored": ORACLE["coach_queue"],
    "patient_search_stored": ORACLE["patient_search_all"],
    "study_extract_stored": ORACLE["study_extract"],
}
