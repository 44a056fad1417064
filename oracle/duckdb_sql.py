"""DuckDB SQL that checks each query of the catalog.

Written apart from the Spark plans: gifts meet their fiscal windows by a range join, first and last
gifts are numbered rows, peer averages sort all amounts. Each text is self-contained.
"""

from __future__ import annotations

import re

from givingledger.names import (
    ALL_DONOR_AVERAGE,
    EMPTY_TEXT_COLUMNS,
    EXPORT_COLUMNS,
    TOP_AVERAGE_PREFIX,
    TOP_AVERAGE_SUFFIX,
    TOP_DONOR_AVERAGE,
    YEARS_BACK,
    ZERO_COLUMNS,
)
from givingledger.sources.sample_views import (
    EXTREME_AMOUNTS,
    ID_DOCUMENTS,
    LISTED_DONORS,
    SAMPLE_SCHEMAS,
    SAMPLE_VIEWS,
)
from givingledger.sources.tables import SCHEMAS

FISCAL_START = "TIMESTAMP '2001-07-01'"
FISCAL_MONTH = 7
TOTAL = "DECIMAL(29,4)"


def sample(text: str) -> str:
    return text.format(**{name: name for name in SAMPLE_SCHEMAS}).strip()


def units(amount: str) -> str:
    """Money as a whole number of ten-thousandths, for exact arithmetic."""
    return f"CAST({amount} * 10000 AS HUGEINT)"


def money_sum(amount: str, window: int) -> str:
    return f"coalesce(sum({amount}) FILTER (WHERE g.k = {window}), 0)::{TOTAL}"


def currency(amount: str) -> str:
    value = f"round({amount}, 2)::DOUBLE"
    return (
        f"CASE WHEN {value} < 0 THEN '(' || format('${{:,.2f}}', abs({value})) || ')' "
        f"ELSE format('${{:,.2f}}', {value}) END"
    )


def dollars(amount: str) -> str:
    value = f"round({amount}, 0)"
    return (
        f"CASE WHEN {value} < 0 THEN '-' ELSE '' END || format('${{:,.0f}}', abs({value}))"
    )


def percent(new: str, base: str) -> str:
    hundredths = f"(({units(new)} - {units(base)}) * 10000) // nullif({units(base)}, 0)"
    return f"({hundredths}) / 100.0"


def half_up(total: str, count: str) -> str:
    """total / count to four decimals, for totals that are not negative."""
    rounded = f"(2 * {units(total)} + {count}) // (2 * nullif({count}, 0))"
    return f"(({rounded}) / 10000.0)::DECIMAL(19,4)"


def named(columns: dict[str, str]) -> str:
    return ",\n  ".join(f'{sql} AS "{name}"' for name, sql in columns.items())


CTES: dict[str, str] = {f"v_{name}": sample(text) for name, text in SAMPLE_VIEWS.items()}
CTES |= {
    "listed": sample(LISTED_DONORS),
    "extreme_amounts": sample(EXTREME_AMOUNTS),
    "documents_of_ids": sample(ID_DOCUMENTS),
    "fw": f"""
        SELECT k, {FISCAL_START} - to_years(k) AS s,
          {FISCAL_START} - to_years(k - 1) - INTERVAL 1 DAY AS e
        FROM (SELECT unnest(range(10))::INT AS k)""",
    "gifts": f"""
        SELECT d.*, fw.k,
          CASE WHEN InKind AND Amount = 0 AND InKindFairMarketValue > 0 THEN InKindFairMarketValue
            WHEN IsStock AND StockFairMarketValue IS NOT NULL THEN StockFairMarketValue
            ELSE Amount END AS Valued,
          CASE WHEN month(DonatedOn) >= {FISCAL_MONTH} THEN year(DonatedOn)
            ELSE year(DonatedOn + INTERVAL {FISCAL_MONTH - 1} MONTH) END AS GivingYear
        FROM v_donations d LEFT JOIN fw ON d.DonatedOn >= fw.s AND d.DonatedOn <= fw.e""",
    "ranked": """
        SELECT DonorProfileID, Amount, DonatedOn,
          row_number() OVER (PARTITION BY DonorProfileID
            ORDER BY DonatedOn NULLS FIRST, Amount NULLS FIRST) AS from_first,
          row_number() OVER (PARTITION BY DonorProfileID
            ORDER BY DonatedOn DESC NULLS LAST, Amount DESC NULLS LAST) AS from_last,
          row_number() OVER (PARTITION BY DonorProfileID
            ORDER BY Amount DESC NULLS LAST, DonatedOn DESC NULLS LAST) AS from_largest
        FROM gifts WHERE DonorProfileID IS NOT NULL""",
    "parents": """
        SELECT DonorProfileID, min(ParentID) AS ParentID,
          min(ParentSystemClassID) AS ParentSystemClassID
        FROM v_donor_links WHERE IsDefault GROUP BY DonorProfileID""",
    "resolved": """
        SELECT dn.*, p.ParentID, p.ParentSystemClassID,
          coalesce(OverrideAddressID, (SELECT min(l.AddressID) FROM v_address_links l
            WHERE l.IsDefault AND l.ParentID = p.ParentID)) AS AddressID,
          coalesce(OverridePhoneNumberID, (SELECT min(l.PhoneNumberID) FROM v_phone_links l
            WHERE l.IsDefault AND l.ParentID = p.ParentID)) AS PhoneNumberID,
          coalesce(OverrideEmailAddressID, (SELECT min(l.EmailAddressID) FROM v_emails l
            WHERE l.ParentID = p.ParentID)) AS EmailAddressID
        FROM v_donors dn LEFT JOIN parents p ON p.DonorProfileID = dn.DonorProfileID""",
    "peers": f"""
        SELECT Amount, row_number() OVER (ORDER BY Amount DESC NULLS LAST) AS place,
          count(*) OVER () AS n
        FROM v_donations
        WHERE DonatedOn BETWEEN {FISCAL_START} - INTERVAL 1 YEAR
          AND {FISCAL_START} + INTERVAL 1 YEAR - INTERVAL 1 DAY - INTERVAL 1 YEAR""",
}

GIVING_YEARS = {"TotalYearsGiven": "count(DISTINCT g.GivingYear)"}
LIFETIME = {
    "LifetimeDonatedAmount": f"sum(g.Amount)::{TOTAL}",
    "AverageDonationAmount": half_up("sum(g.Amount)", "count(g.Amount)"),
}
STATUS = {
    "DonorStatus": f"""CASE WHEN count(g.DonationCampaignID) = 0 THEN 'Never Donated'
    WHEN max(g.DonatedOn) > {FISCAL_START} THEN 'Current Donor'
    WHEN max(g.DonatedOn) > {FISCAL_START} - INTERVAL 1 YEAR THEN 'Lapsing'
    WHEN max(g.DonatedOn) > {FISCAL_START} - INTERVAL 3 YEAR THEN 'Lapsed'
    ELSE 'Former Donor' END"""
}


def counted(condition: str) -> str:
    return f"count(g.DonatedOn) FILTER (WHERE {condition})"


LIFETIME_COUNTS = {
    "NumberOfGiftsAndPledgesLifetime": counted("NOT g.IsStock AND NOT g.InKind"),
    "NumberOfStockDonationsLifetime": counted("g.IsStock"),
    "NumberOfInKindDonationsLifetime": counted("g.InKind"),
}
THIS_YEAR_COUNTS = {
    "NumberOfGiftsAndPledgesYearToDate": counted("g.k = 0 AND NOT g.IsStock AND NOT g.InKind"),
    "NumberOfStockDonationsYearToDate": counted("g.k = 0 AND NOT g.IsStock"),
    "NumberOfInKindDonationsYearToDate": counted("g.k = 0 AND NOT g.InKind"),
}
LAST_YEAR_COUNTS = {
    "NumberOfGiftsAndPledgesLastFiscalYear": counted("g.k = 1 AND NOT g.IsStock AND NOT g.InKind"),
    "NumberOfStockDonationsLastFiscalYear": counted("g.k = 1 AND g.IsStock"),
    "NumberOfInKindDonationsLastFiscalYear": counted("g.k = 1 AND g.InKind"),
}
WINDOW_TOTALS = {
    f"Donated{YEARS_BACK[k]}YearsAgo": money_sum("g.Amount", k) for k in range(2, 10)
}
WINDOW_FORMATTED = {
    f"Donated{YEARS_BACK[k]}YearsAgoFormatted": currency(money_sum("g.Amount", k))
    for k in range(2, 10)
}
WINDOW_VALUED = {f"Valued{k}": money_sum("g.Valued", k) for k in range(9)}
LAST_YEAR = {
    "DonatedLastYear": money_sum("g.Valued", 0),
    "DonatedLastYearFormatted": currency(money_sum("g.Valued", 0)),
}
THREE_YEARS = {"DonatedPreviousThreeYears": money_sum("g.Valued", 3)}
# Output name -> window of the newer, valued sum and window of the base.
CHANGES = {"PercentChangeFromLastFiscalYear": (1, 0), "PercentChangeFromTwoFYAgoToOneFYAgo": (0, 2)}
CHANGES |= {
    f"PercentChangeFrom{YEARS_BACK[k + 1]}FYAgoTo{YEARS_BACK[k]}FYAgo": (k, k + 1)
    for k in range(2, 9)
}
PERCENTS = {
    name: percent(money_sum("g.Valued", new), money_sum("g.Amount", base))
    for name, (new, base) in CHANGES.items()
}
PERCENTS = {
    name: f"CAST({sql} AS DECIMAL(19,4))"
    if name == "PercentChangeFromLastFiscalYear"
    else f"CAST(CAST({sql} AS DECIMAL(19,2)) AS VARCHAR)"
    for name, sql in PERCENTS.items()
}
GIVING = {
    **STATUS,
    **GIVING_YEARS,
    **LIFETIME_COUNTS,
    **LIFETIME,
    **THREE_YEARS,
    **THIS_YEAR_COUNTS,
    **LAST_YEAR_COUNTS,
    **LAST_YEAR,
    **PERCENTS,
    **WINDOW_TOTALS,
    **WINDOW_FORMATTED,
}
LABEL_NAMES = {0: "FiscalYearToDate", 1: "FiscalLastYear"} | {
    k: f"Fiscal{YEARS_BACK[k]}YearsAgo" for k in range(2, 10)
}


def per_donor(columns: dict[str, str]) -> str:
    return f"""SELECT dn.DonorProfileID, {named(columns)}
FROM v_donors dn LEFT JOIN gifts g ON g.DonorProfileID = dn.DonorProfileID
GROUP BY dn.DonorProfileID"""


def placed(rank: str, columns: dict[str, str]) -> str:
    return f"""SELECT dn.DonorProfileID, {named(columns)}
FROM v_donors dn LEFT JOIN ranked r ON r.DonorProfileID = dn.DonorProfileID AND r.{rank} = 1"""


WINDOW_LABEL = """strftime(s, '%d-%m-%Y') || CASE WHEN k = 0 THEN ' - ' ELSE '-' END
  || strftime(e, '%d-%m-%Y')"""
WINDOW_LABELS = {
    name: f"(SELECT {WINDOW_LABEL} FROM fw WHERE k = {k})" for k, name in LABEL_NAMES.items()
}

FIRST = placed(
    "from_first", {"FirstDonationDate": "r.DonatedOn", "FirstDonationAmount": "r.Amount"}
)
LAST = placed("from_last", {"LastDonationAmount": "r.Amount", "LastDonationDate": "r.DonatedOn"})
LARGEST = placed(
    "from_largest", {"LargestDonationAmount": "r.Amount", "LargestDonationDate": "r.DonatedOn"}
)
CTES |= {
    "giving": per_donor(GIVING),
    "first_gifts": FIRST,
    "last_gifts": LAST,
    "largest_gifts": LARGEST,
}
ALL_GIVING = f"""SELECT giving.*, first_gifts.* EXCLUDE (DonorProfileID),
  last_gifts.* EXCLUDE (DonorProfileID), largest_gifts.* EXCLUDE (DonorProfileID),
  {named(WINDOW_LABELS)}
FROM giving JOIN first_gifts USING (DonorProfileID) JOIN last_gifts USING (DonorProfileID)
  JOIN largest_gifts USING (DonorProfileID)"""

CONTACTS = """SELECT r.DonorProfileID, r.CalculatedGivingName AS ActualGivingName,
  r.CalculatedGreeting AS ActualGreeting,
  a.SalutationFirstname || a.SalutationLastname AS ActualAddressSalutation, a.FamilySalutation,
  coalesce(a.Address1, '') || coalesce(a.Address2, '') || ' ' || coalesce(a.City, '') || ' '
    || coalesce(a.Region, '') || ' ' || coalesce(a.PostalCode, '') AS RecipientAddress,
  a.Address1, a.Address2, a.City, a.Region, a.PostalCode, a.CountryCode,
  e.Email AS ActualEmailAddressTitle, t.Number AS ActualPhoneNumberTitle
FROM resolved r LEFT JOIN v_addresses a ON a.AddressID = r.AddressID
  LEFT JOIN v_emails e ON e.EmailAddressID = r.EmailAddressID
  LEFT JOIN v_phones t ON t.PhoneNumberID = r.PhoneNumberID
    AND t.PhoneNumberID IN (SELECT PhoneNumberID FROM v_phone_links)"""
FUND_FLAG = """SELECT r.DonorProfileID,
  coalesce(r.IsDonorAdvisedFund, FALSE) OR coalesce(r.ParentSystemClassID = 3, FALSE)
    OR EXISTS (SELECT 1 FROM v_companies c WHERE c.CompanyID = r.ParentID
      AND c.OrganizationType = 'Donor Advised Fund') AS IsDonorAdvisedFund
FROM resolved r"""


def campaign(campaign_id: int) -> str:
    return f"""SELECT (SELECT Title FROM v_campaigns
    WHERE DonationCampaignID = {campaign_id}) AS CampaignTitle,
  (SELECT GoalAmount FROM v_campaigns WHERE DonationCampaignID = {campaign_id}) AS CampaignGoal,
  coalesce(sum(Amount), 0)::DOUBLE AS AmountRaised,
  round(coalesce(coalesce(sum(Amount), 0)::DOUBLE / nullif((SELECT GoalAmount FROM v_campaigns
    WHERE DonationCampaignID = {campaign_id}), 0) * 100, 0), 0) AS PercentToGoal
FROM v_donations WHERE DonationCampaignID = {campaign_id}"""


URL = "'https://hillside.example/forms/donation/' || CampaignTitle"
CAMPAIGN_COLUMNS = {
    "DonationCampaignTitle": "CampaignTitle",
    "DonationCampaignGoalFromTemplate": dollars("CampaignGoal"),
    "DonationCampaignRaisedFromTemplate": dollars("AmountRaised"),
    "DonationCampaignRemainingFromTemplate": dollars("(CampaignGoal - AmountRaised)"),
    "DonationCampaignPercentToGoalFromTemplate": "CAST(PercentToGoal AS BIGINT) || '%'",
    "LinkToDonationForm": f"""'<a href="' || {URL} || '" target="_blank">Donate Here</a>'""",
    "UrlToDonationForm": URL,
}


def campaign_columns(campaign_id: int) -> str:
    return f"""SELECT DonorProfileID, {named(CAMPAIGN_COLUMNS)}
FROM v_donors, ({campaign(campaign_id)}) AS progress"""


YEAR_TO_DATE_TOTAL = f"coalesce(sum(Valued) FILTER (WHERE k = 0), 0)::{TOTAL}"
YEAR_TO_DATE = f"""SELECT {YEAR_TO_DATE_TOTAL} AS DonatedYearToDate,
  {currency(YEAR_TO_DATE_TOTAL)} AS DonatedYearToDateFormatted
FROM gifts"""


def averages(percent_taken: int) -> str:
    return f"""SELECT n AS Gifts, take AS Take, sum(Amount)::{TOTAL} AS Donated,
  (sum(Amount) FILTER (WHERE place <= take))::{TOTAL} AS TopDonated,
  ceil(sum(Amount)::DOUBLE / n / 10) * 10 AS "{ALL_DONOR_AVERAGE}",
  ceil((sum(Amount) FILTER (WHERE place <= take))::DOUBLE / take / 10) * 10
    AS "{TOP_DONOR_AVERAGE}"
FROM (SELECT *, CASE WHEN n * {percent_taken} // 100 BETWEEN 1 AND n
  THEN n * {percent_taken} // 100 ELSE n END AS take FROM peers)
GROUP BY n, take"""


AVERAGE_COLUMNS = f'"{ALL_DONOR_AVERAGE}", "{TOP_DONOR_AVERAGE}"'


def gift_labels(name: str, table: str, key: str) -> str:
    return f"""SELECT DonorProfileID,
  (SELECT string_agg(label, ', ' ORDER BY label) FROM (
    SELECT t.Title || ' ($' || sum(g.Amount)::DECIMAL(31,2) || ')' AS label
    FROM v_donations g JOIN {table} t USING ({key})
    WHERE g.DonorProfileID = dn.DonorProfileID GROUP BY t.Title)) AS {name}
FROM v_donors dn"""


CAMPAIGN_LABELS = gift_labels("Campaigns", "v_campaigns", "DonationCampaignID")
FUND_LABELS = gift_labels("Funds", "v_funds", "FundID")
APPEAL_LABELS = gift_labels("Appeals", "v_appeals", "DonationAppealID")
NOTES = """SELECT dn.DonorProfileID, n.NoteText || ' (' || u.UserName || ', '
  || strftime(n.Created, '%Y-%m-%d') || ')' AS Notes
FROM v_donors dn LEFT JOIN v_notes n ON n.ParentID = dn.DonorProfileID
  LEFT JOIN v_users u ON u.UserID = n.CreatedBy"""
GIVING_LEVELS = """SELECT DonationTemplateID,
  string_agg('$' || Amount::DECIMAL(19,2) || '|', '' ORDER BY Amount) AS GivingLevels,
  string_agg(Title || ':' || Amount::DECIMAL(19,2) || ' | ', '' ORDER BY Amount, Title)
    AS GivingLevelsWithTitles
FROM v_giving_levels WHERE DonationTemplateID IS NOT NULL AND Active GROUP BY DonationTemplateID"""

CONSTANTS = {
    "SchoolName": "'Hillside School'",
    "SchoolAddress": "'1 Hill Road'",
    "SchoolPhone": "'555-0100'",
    "SchoolEmailAddress": "'giving@hillside.example'",
    "CurrentDate": "'12/01/2001'",
}
PLACEHOLDERS = {name: "''" for name in EMPTY_TEXT_COLUMNS} | {name: "0" for name in ZERO_COLUMNS}

CTES |= {
    "all_giving": ALL_GIVING,
    "contacts": CONTACTS,
    "fund_flags": FUND_FLAG,
    "campaign_texts": campaign_columns(1),
    "year_to_date": YEAR_TO_DATE,
    "school": averages(10),
    "campaign_labels": CAMPAIGN_LABELS,
    "fund_labels": FUND_LABELS,
    "appeal_labels": APPEAL_LABELS,
    "note_texts": NOTES,
}
EXPORT = f"""SELECT {", ".join(f'"{name}"' for name in EXPORT_COLUMNS)}
FROM (SELECT *, {named(CONSTANTS | PLACEHOLDERS)}
  FROM contacts JOIN fund_flags USING (DonorProfileID) JOIN all_giving USING (DonorProfileID)
    JOIN campaign_texts USING (DonorProfileID) JOIN campaign_labels USING (DonorProfileID)
    JOIN fund_labels USING (DonorProfileID) JOIN appeal_labels USING (DonorProfileID)
    JOIN note_texts USING (DonorProfileID), year_to_date, school)"""

BODIES = {
    "scan_donor_base": f"SELECT *, {named(CONSTANTS)} FROM v_donors",
    "scan_table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, count(*) AS Rows, "
        f"count({SCHEMAS[name].split()[0]}) AS KnownIDs FROM v_{name}"
        for name in SCHEMAS
    ),
    "donor_id_list_xml": """
        SELECT CAST(trim(id) AS BIGINT) AS ProfileID
        FROM (SELECT unnest(regexp_extract_all(Document, '<Guid>([^<]*)</Guid>', 1)) AS id
          FROM documents_of_ids)""",
    "donor_filter_by_ids": """
        SELECT DonorProfileID, CalculatedGivingName FROM v_donors
        WHERE DonorProfileID IN (SELECT ProfileID FROM listed)""",
    "donor_filter_text_keys": """
        SELECT lower(c_name) AS DonorProfileID, c_name AS CalculatedGivingName FROM customer
        WHERE c_mktsegment = 'BUILDING'""",
    "donor_filter_empty_list": "SELECT DonorProfileID, CalculatedGivingName FROM v_donors",
    "valued_donations": """
        SELECT DonorProfileID, DonatedOn, Amount, IsStock, InKind, Valued AS ValuedAmount
        FROM gifts""",
    "donations_in_window": "SELECT DonorProfileID, DonatedOn, Amount FROM gifts WHERE k = 2",
    "fiscal_windows": f"""
        SELECT k AS YearsBack, s AS WindowStart, e AS WindowEnd, {WINDOW_LABEL} AS Label,
          count(gifts.k) AS Gifts, coalesce(sum(Amount), 0)::{TOTAL} AS Donated
        FROM fw LEFT JOIN gifts USING (k) GROUP BY fw.k, s, e""",
    "lifetime_totals": per_donor(LIFETIME),
    "donor_status": per_donor(STATUS),
    "total_years_given": per_donor(GIVING_YEARS),
    "gift_counts_lifetime": per_donor(LIFETIME_COUNTS),
    "gift_counts_ytd": per_donor(THIS_YEAR_COUNTS),
    "gift_counts_last_fy": per_donor(LAST_YEAR_COUNTS),
    "first_gift": FIRST,
    "last_gift": LAST,
    "largest_gift": LARGEST,
    "fy_window_totals": per_donor(WINDOW_TOTALS),
    "fy_window_formatted": per_donor(WINDOW_FORMATTED),
    "fy_window_valued": per_donor(WINDOW_VALUED),
    "donated_last_year": per_donor(LAST_YEAR),
    "donated_previous_three_years": per_donor(THREE_YEARS),
    "percent_changes": per_donor(PERCENTS),
    "donor_rollup": ALL_GIVING,
    "ytd_total_all_donors": "SELECT DonorProfileID, year_to_date.* FROM v_donors, year_to_date",
    "default_parent": "SELECT DonorProfileID, ParentID, ParentSystemClassID FROM parents",
    "address_resolution": """
        SELECT r.DonorProfileID, r.AddressID, a.Address1, a.City, a.PostalCode
        FROM resolved r LEFT JOIN v_addresses a ON a.AddressID = r.AddressID""",
    "phone_resolution": """
        SELECT r.DonorProfileID, r.PhoneNumberID, c.ActualPhoneNumberTitle AS Number
        FROM resolved r JOIN contacts c USING (DonorProfileID)""",
    "email_resolution": """
        SELECT r.DonorProfileID, r.EmailAddressID, e.Email
        FROM resolved r LEFT JOIN v_emails e ON e.EmailAddressID = r.EmailAddressID""",
    "is_donor_advised_fund": FUND_FLAG,
    "contact_block": CONTACTS,
    "campaign_summary": campaign(1),
    "campaign_columns": campaign_columns(1),
    "campaign_columns_unknown": campaign_columns(99),
    "school_prev_fy_amounts": "SELECT Amount FROM peers",
    "school_prev_fy_amounts_campaign": """
        SELECT Amount FROM gifts WHERE k = 1 AND DonationCampaignID = 3""",
    "school_averages": f"SELECT DonorProfileID, {AVERAGE_COLUMNS} FROM v_donors, school",
    "school_averages_empty": f"""
        SELECT DonorProfileID, CAST(NULL AS DOUBLE) AS "{ALL_DONOR_AVERAGE}",
          CAST(NULL AS DOUBLE) AS "{TOP_DONOR_AVERAGE}" FROM v_donors""",
    "school_top_average": averages(25).replace(
        f'  ceil(sum(Amount)::DOUBLE / n / 10) * 10 AS "{ALL_DONOR_AVERAGE}",\n', ""
    ),
    "top_average_sentence": f"""
        SELECT '{TOP_AVERAGE_PREFIX}' || CAST("{TOP_DONOR_AVERAGE}" AS BIGINT)
          || '{TOP_AVERAGE_SUFFIX}' AS TopAverageSentence
        FROM school""",
    "donor_campaigns": CAMPAIGN_LABELS,
    "donor_funds": FUND_LABELS,
    "donor_appeals": APPEAL_LABELS,
    "donor_notes": NOTES,
    "giving_levels": GIVING_LEVELS,
    "giving_levels_of_form": GIVING_LEVELS.replace(
        "DonationTemplateID IS NOT NULL", "DonationTemplateID = 7"
    ),
    "export_placeholders": f"SELECT DonorProfileID, {named(PLACEHOLDERS)} FROM v_donors",
    "donor_export": EXPORT,
    "donor_export_listed": f"""
        SELECT * FROM ({EXPORT}) WHERE DonorProfileID IN (SELECT ProfileID FROM listed)""",
}


def guid(key: str) -> str:
    number = f"({key} + 1073741824)"
    return f"""CASE WHEN {key} IS NOT NULL THEN lpad(lower(hex({number} // 16)), 8, '0')
      || '-0000-4000-8000-' || lpad(lower(hex({number} % 16)), 12, '0') END"""


# The quotient in whole numbers of 128 bits, which cut towards zero like the original.
BODIES |= {
    "donor_export_laid_out": EXPORT,
    "default_parent_guid": f"""
        SELECT {guid("DonorProfileID")} AS DonorProfileID, {guid("ParentID")} AS ParentID, ParentSystemClassID
        FROM parents""",
    "parent_contacts_guid": f"""
        SELECT {guid("ParentID")} AS ParentID, {guid("min(a)")} AS ParentAddressID, {guid("min(p)")} AS ParentPhoneNumberID,
          {guid("min(e)")} AS ParentEmailAddressID
        FROM (SELECT ParentID, AddressID AS a, NULL AS p, NULL AS e FROM v_address_links WHERE IsDefault
          UNION ALL SELECT ParentID, NULL, PhoneNumberID, NULL FROM v_phone_links WHERE IsDefault AND PhoneNumberID IS NOT NULL
          UNION ALL SELECT ParentID, NULL, NULL, EmailAddressID FROM v_emails)
        WHERE ParentID IS NOT NULL GROUP BY ParentID""",
    "percent_changes_extreme": """
        SELECT OrderKey, (((((New - Base) * 10000)::HUGEINT * 10000) // nullif((Base * 10000)::HUGEINT, 0))::DECIMAL(36,0)
          * 0.01)::DECIMAL(34,2) AS PercentChange
        FROM extreme_amounts""",
}
BODIES["donor_filter_by_ids_nonempty"] = BODIES["donor_filter_by_ids"]


def self_contained(body: str) -> str:
    """The body after the CTEs it uses, directly or through others."""
    used: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = (words & CTES.keys()) - used
        used |= new
        pending += [CTES[name] for name in new]
    ctes = [f"{name} AS ({text.strip()})" for name, text in CTES.items() if name in used]
    return f"WITH {', '.join(ctes)}\n{body.strip()}" if ctes else body.strip()


# The same three years later, where all ten windows hold gifts.
LATER = ("percent_changes", "donor_rollup", "fiscal_windows")


def three_years_later(sql: str) -> str:
    return sql.replace(FISCAL_START, "TIMESTAMP '2004-07-01'").replace("12/01/2001", "12/01/2004")


def oracle_queries() -> dict[str, str]:
    found = {name: self_contained(body) for name, body in BODIES.items()}
    return found | {f"{name}_later": three_years_later(found[name]) for name in LATER}
