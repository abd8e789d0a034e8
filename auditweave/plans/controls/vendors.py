"""Controls over vendor master data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.envelope import FLAGS, Label, emit, time_flags
from auditweave.functions.keys import full_address, joined_key
from auditweave.operators.completeness import any_missing
from auditweave.operators.groups import (
    label_group,
    members_of,
    shared_key_groups,
    with_group_number,
)
from auditweave.operators.matching import MatchRule, match_by_rules, similar_text_pairs
from auditweave.operators.ordering import dense_numbers
from auditweave.plans.scope import in_scope_spend, scope_columns, vendor_categories
from auditweave.sources.shelf import pin

L2 = "supplier_custom_category_l2"
ACTIVE = "A"
HOME_COUNTRY = "AU"
SIMILAR_EDITS = 5
SHARED_BANK_FLOOR = 5000
#: The account keys of a party without any account.
NO_SHORT_KEY, NO_LONG_KEY = "-", "--"

# The report texts below.
EMPLOYEE_BANK = Label(
    "Payments", "Scan for same bank details between vendors and employees", "Vendor Count"
)
EMPLOYEE_BANK_PAYMENTS = Label(
    "Payments",
    "Scan for same bank details between vendors and employees with payments over 5000",
    "Employee Count",
)
DUPLICATE_VENDORS = Label(
    "Payments",
    "Scan for duplicate vendors e.g. same address, same bank details,same ABN or address",
    "Duplicate Vendors",
)
APPROVED_VS_BLOCKED = Label(
    "Payments",
    "Scan for blocked vendors sharing same address and bank details as approved vendors.",
    "Duplicate Vendors",
)
REONBOARDED = Label(
    "Vendor Profile",
    "Detect if previously banned vendors are re-onboarded using similar details",
    "Vendor Count",
)
SAME_CONTACT = Label("Vendor Profile", "Suppliers with same financial contact", "Vendor Count")
NO_BANK = Label(
    "Payments",
    "check missing bank details for any active suppliers",
    "Vendor with no bankacounts",
)
LOCAL_INCOMPLETE = Label(
    "Other",
    "Master data completeness for local vendors",
    "Local Vendors Count",
)
INTERNATIONAL_INCOMPLETE = Label(
    "Other",
    "Master data completeness for International vendors",
    "International Vendors Count",
)

_PROFILE = [
    "supplier_id",
    "supplier_name",
    "abn",
    "supplier_creation_date",
    "building_number",
    "street",
    "city",
    "postal_code",
    "state",
    "country",
    "full_address",
]
_BANK = ["bank_country_key", "bank_keys", "bank_account_number", "account_holder_name"]
_SHORT_BANK_KEY = ["bank_keys", "bank_account_number"]
_LONG_BANK_KEY = ["bank_country_key", *_SHORT_BANK_KEY]


def _profiles(vendors: DataFrame, *more: str) -> DataFrame:
    return vendors.select(
        F.col("vendor").alias("supplier_id"),
        F.col("vendor_description").alias("supplier_name"),
        F.trim("tax_id").alias("abn"),
        F.col("date_first_created").alias("supplier_creation_date"),
        "building_number",
        "street",
        "city",
        "postal_code",
        "state",
        "country",
        full_address().alias("full_address"),
        *more,
    )


def _banked(src, status: Column, how: str = "inner", *more: str) -> DataFrame:
    """Profiles of vendors with a status, one row per bank account."""
    accounts = src.vendor_bank.select(F.col("vendor").alias("supplier_id"), *_BANK)
    return _profiles(src.dim_vendor.filter(status), *more).join(accounts, "supplier_id", how)


def _active() -> Column:
    return F.col("vendor_status") == ACTIVE


def _blocked() -> Column:
    return (F.col("vendor_status") != ACTIVE) & (F.col("vendor_status") != "")


# --- vendors and employees -------------------------------------------------------------


def _employee_accounts(book, filled: bool = False) -> DataFrame:
    """Active vendors' accounts that are also an employee's.

    As written, vendors and employees without any account share a key; ``filled`` leaves
    them out. Both sides are dealt by account: keys that follow each other take next to no room
    as files, so by their size the planner would send millions of them to the driver.
    """
    src = book.src
    accounts = src.payroll_bank.select(
        "employee_id", joined_key("bank_number", "bank_account_number").alias("emp_bank_key")
    ).distinct()
    vendors = (
        _banked(src, _active()).withColumn("bank_key", joined_key(*_SHORT_BANK_KEY)).distinct()
    )
    if filled:
        vendors = vendors.filter(F.col("bank_key") != NO_SHORT_KEY)
    return vendors.hint("merge").join(
        accounts.hint("merge"), F.col("bank_key") == F.col("emp_bank_key")
    )


def _with_employees(book, matched: DataFrame, spend: DataFrame) -> DataFrame:
    people = book.src.employee.select(
        F.col("employee_id").alias("_employee"),
        "first_name",
        "last_name",
        "first_day_at_work",
        "employment_status",
        "employee_type",
        "job_title",
    )
    rows = (
        # employees and spend grow with the tables; see _employee_accounts
        matched.join(people.hint("merge"), F.col("employee_id") == F.col("_employee"), "left")
        .drop("_employee")
        .distinct()
        .join(spend.hint("merge"), "supplier_id")
    )
    return emit(rows, EMPLOYEE_BANK, "supplier_creation_date", book.today, keep_area=True)


def _spend_of(src, vendors: DataFrame) -> DataFrame:
    """In-scope spend rows of the given vendors only: few vendors are ever found, so the
    rest of the spend cube leaves before it is shuffled."""
    return (
        in_scope_spend(src)
        .select(
            F.col("vendor_id").alias("supplier_id"), F.col("category_l2").alias(L2), "amount"
        )
        .join(vendors.select("supplier_id").distinct(), "supplier_id", "left_semi")
    )


def vendor_employee_same_bank(book, filled: bool = False) -> DataFrame:
    """Active vendors paid into an employee's account, per distinct spend amount."""
    matched = pin(_employee_accounts(book, filled), "employee-accounts")
    return _with_employees(book, matched, _spend_of(book.src, matched).distinct())


def vendor_employee_same_address(book, filled: bool = False) -> DataFrame:
    """The same account match with spend summed per vendor and category.

    Its name says address; the employee extract holds none, so the account is compared.
    """
    matched = pin(_employee_accounts(book, filled), "employee-accounts")
    spend = (
        _spend_of(book.src, matched)
        .groupBy("supplier_id", L2)
        .agg(F.sum("amount").alias("amount"))
    )
    return _with_employees(book, matched, spend)


def payments_shared_bank(book, summed: bool = False) -> DataFrame:
    """Payments over the floor to vendors that share an account with an employee.

    As written a payment stands beside each distinct spend amount of its vendor; ``summed``
    gives it once per account match and category, beside their spend.
    """
    source = "vendor_employee_same_address" if summed else "vendor_employee_same_bank"
    matches = book.table(source).drop("routine_description", "metric_description", *FLAGS)
    payments = (
        book.table("base_payment")
        .filter(F.col("payment_amount") > SHARED_BANK_FLOOR)
        .select(F.col("d_vendor").alias("supplier_id"), "payment_date", "payment_amount")
    )
    # both sides repeat a vendor's values, so as files they are far smaller than as rows
    rows = matches.join(payments.hint("merge"), "supplier_id").withColumns(
        {
            "routine_description": F.lit(EMPLOYEE_BANK_PAYMENTS.description),
            "metric_description": F.lit(EMPLOYEE_BANK_PAYMENTS.metric),
        }
    )
    return time_flags(rows, "payment_date", book.today)


# --- vendors alike ---------------------------------------------------------------------


def dupe_vendors(book) -> DataFrame:
    """Active vendors sharing a tax number, an address or a bank account."""
    src = book.src
    vendors = (
        _banked(src, _active())
        .join(vendor_categories(book, "supplier_id"), "supplier_id")
        .withColumn("bank_key", joined_key(*_LONG_BANK_KEY))
        .distinct()
    )
    vendors = pin(vendors, "accounts")  # read twice for each of three reasons
    reasons = [
        ("ABN dupe", "abn", F.col("abn") != ""),
        ("Address dupe", "full_address", F.col("full_address") != ""),
        ("Bank dupe", "bank_key", ~F.col("bank_key").isin("", "--")),
    ]
    found = [
        shared_key_groups(vendors, key, usable)
        .select(
            "supplier_id",
            "supplier_name",
            "supplier_creation_date",
            "abn",
            "full_address",
            *_BANK,
            F.lit(reason).alias("duplicate_reason"),
            "group_number",
            L2,
            label_group("group_number", "group ").alias("duplicate_group"),
            F.lit("Yes").alias("is_duplicate"),
        )
        .distinct()
        for reason, key, usable in reasons
    ]
    rows = reduce(DataFrame.unionByName, found).withColumn(
        "_order",
        F.concat("supplier_id", "duplicate_reason", F.col("group_number").cast("string")),
    )
    rows = pin(rows, "duplicates")
    rows = members_of(rows, dense_numbers(rows, ["_order"], "new_group_number"), ["_order"])
    return emit(
        rows.drop("_order"),
        DUPLICATE_VENDORS,
        "supplier_creation_date",
        book.today,
        keep_area=True,
    )


def _blocked_and_approved(book) -> tuple[DataFrame, DataFrame]:
    categories = vendor_categories(book, "supplier_id")

    def side(status: Column, prefix: str) -> DataFrame:
        rows = (
            _banked(book.src, status)
            .join(categories, "supplier_id")
            .withColumn("bank_key", joined_key(*_LONG_BANK_KEY))
        )
        return rows.select(
            F.col("supplier_id").alias(f"{prefix}_supplier_id"),
            F.col("supplier_name").alias(f"{prefix}_supplier_name"),
            F.col("full_address").alias(f"{prefix}_address"),
            F.col("bank_key").alias(f"{prefix}_bank_key"),
            F.col("abn").alias(f"{prefix}_abn"),
            F.col("supplier_creation_date").alias(f"{prefix}_vendor_creation_date"),
            F.col(L2).alias(f"{prefix}_{L2}"),
        ).distinct()

    # each side meets the other once per rule
    return pin(side(_blocked(), "blocked"), "blocked"), pin(side(_active(), "approved"), "approved")


def approved_vs_blocked(book, filled: bool = False) -> DataFrame:
    """Blocked vendors beside approved ones with the same account, address or tax number,
    or an address at most five edits away.

    The alternatives are separate equi-joins; a pair found by several is kept once and its
    reason is decided afterwards, in a fixed order. ``filled`` lets blanks match nothing.
    """
    blocked, approved = _blocked_and_approved(book)
    blanks = {"bank_key": NO_LONG_KEY, "address": "", "abn": ""}

    def given(side: str, key: str) -> Column:
        return F.col(f"{side}_{key}") != blanks[key] if filled else F.lit(True)

    exact = match_by_rules(
        blocked,
        approved,
        [
            MatchRule(
                "", [F.col(f"blocked_{k}")], [F.col(f"approved_{k}")], given("blocked", k)
            )
            for k in blanks
        ],
    ).drop("match_reason")
    # the other side is written out in pieces, so that is the few blocked vendors
    near = similar_text_pairs(
        approved.filter(given("approved", "address")),
        blocked.filter(given("blocked", "address")),
        "approved_address",
        "blocked_address",
        SIMILAR_EDITS,
    ).filter(F.col("blocked_address") != F.col("approved_address"))
    similar = blocked.join(near, "blocked_address").join(approved, "approved_address")

    def same(key: str) -> Column:
        return (F.col(f"blocked_{key}") == F.col(f"approved_{key}")) & given("blocked", key)

    # Reason texts, in order of precedence.
    reason = (
        F.when(same("bank_key") & same("address"), "Exact match: Bank and Address")
        .when(same("bank_key"), "Exact match: Bank only")
        .when(same("address"), "Exact match: Address only")
        .when(same("abn"), "Exact match: ABN only")
        .otherwise("Similar address")
    )
    rows = exact.unionByName(similar).distinct().withColumn("match_reason", reason)
    rows = _numbered_by_approved(rows)
    areas = {
        "approved_vendor_area": F.col(f"approved_{L2}"),
        "blocked_vendor_area": F.col(f"blocked_{L2}"),
    }
    return emit(
        rows.withColumns(areas),
        APPROVED_VS_BLOCKED,
        "approved_vendor_creation_date",
        book.today,
        area=None,
    )


def _numbered_by_approved(rows: DataFrame) -> DataFrame:
    rows = pin(rows, "matches")
    numbers = dense_numbers(rows, ["approved_supplier_id"], "_number")
    return (
        members_of(rows, numbers, ["approved_supplier_id"])
        .withColumn("new_group_number", label_group("_number"))
        .drop("_number")
    )


def blocked_reonboarded(book, filled: bool = False) -> DataFrame:
    """Blocked vendors whose details reappear on another, approved vendor.

    As written, accounts without numbers and telephone texts without digits match each
    other; ``filled`` lets them match nothing.
    """
    src = book.src
    categories = vendor_categories(book, "supplier_id")
    contact = ["financial_party_contact_name", "email_address", "telephone_number"]

    def side(status: Column, names: dict[str, str]) -> DataFrame:
        rows = _banked(src, status, "inner", *contact).join(categories, "supplier_id")
        return pin(rows.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct(), "side")

    blocked = side(
        _blocked(),
        {
            "supplier_id": "blocked_supplier_id",
            "supplier_name": "blocked_supplier_name",
            "abn": "blocked_supplier_abn",
            "supplier_creation_date": "_blocked_creation_date",
            L2: "_blocked_category",
            "financial_party_contact_name": "blocked_financialpartycontactname",
            "email_address": "blocked_emailaddress",
            "full_address": "blocked_full_address",
            "telephone_number": "blocked_telephonenumber",
            "bank_keys": "blocked_bsb",
            "bank_account_number": "blocked_accountnumber",
        },
    )
    approved = side(
        _active(),
        {
            "supplier_id": "approved_supplier_id",
            "supplier_name": "approved_supplier_name",
            "abn": "approved_abn",
            "supplier_creation_date": "approved_supplier_creation_date",
            L2: f"approved_{L2}",
            "financial_party_contact_name": "approved_financialpartycontactname",
            "email_address": "approved_emailaddress",
            "full_address": "approved_full_address",
            "telephone_number": "approved_telephonenumber",
            "bank_keys": "approved_bsb",
            "bank_account_number": "approved_accountnumber",
        },
    )

    def digits(col: str) -> Column:
        return F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", "")

    def letters_digits(col: str) -> Column:
        return F.regexp_replace(F.lower(F.trim(col)), "[^a-z0-9]", "")

    def filled_in(col: str) -> Column:
        return F.coalesce(col, F.lit("")) != ""

    def equal(blocked_col: str, approved_col: str) -> tuple[list[Column], list[Column]]:
        return [F.col(blocked_col)], [F.col(approved_col)]

    rules = [
        MatchRule(
            "Matched on BSB + Account Number",
            [F.col("blocked_bsb"), F.col("blocked_accountnumber")],
            [F.col("approved_bsb"), F.col("approved_accountnumber")],
            filled_in("blocked_bsb") & filled_in("blocked_accountnumber") if filled else None,
        ),
        MatchRule(
            "Matched on Email",
            *equal("blocked_emailaddress", "approved_emailaddress"),
            filled_in("blocked_emailaddress"),
        ),
        MatchRule(
            "Matched on Phone Number",
            [digits("blocked_telephonenumber")],
            [digits("approved_telephonenumber")],
            ~F.coalesce("blocked_telephonenumber", F.lit("")).isin("", "N/A")
            & (digits("blocked_telephonenumber") != "" if filled else F.lit(True)),
        ),
        MatchRule(
            "Matched on ABN",
            *equal("blocked_supplier_abn", "approved_abn"),
            filled_in("blocked_supplier_abn"),
        ),
        MatchRule(
            "Matched on Address",
            [letters_digits("blocked_full_address")],
            [letters_digits("approved_full_address")],
            filled_in("blocked_full_address"),
        ),
        MatchRule(
            "Matched on Financial Party Contact Name",
            *equal("blocked_financialpartycontactname", "approved_financialpartycontactname"),
            filled_in("blocked_financialpartycontactname"),
        ),
    ]
    rows = (
        match_by_rules(blocked, approved, rules)
        .filter(F.col("blocked_supplier_id") != F.col("approved_supplier_id"))
        .drop("_blocked_creation_date", "_blocked_category")
        .distinct()
    )
    return emit(
        _numbered_by_approved(rows),
        REONBOARDED,
        "approved_supplier_creation_date",
        book.today,
        area=f"approved_{L2}",
        keep_area=True,
    )


def same_financial_contact(book) -> DataFrame:
    """Vendors that share a financial contact, whatever their status."""
    src = book.src
    vendors = (
        _profiles(src.dim_vendor, "financial_party_contact_name")
        .join(vendor_categories(book, "supplier_id"), "supplier_id")
        .distinct()
    )
    vendors = pin(vendors, "profiles")
    key = "financial_party_contact_name"
    # the group of vendors without a contact takes a number but has no members
    groups = vendors.groupBy(key).agg(F.count("*").alias("vendor_cnt")).filter("vendor_cnt > 1")
    rows = members_of(vendors, with_group_number(groups, [key]), [key])
    return emit(rows, SAME_CONTACT, "supplier_creation_date", book.today, keep_area=True)


# --- incomplete vendors ----------------------------------------------------------------


def vendors_no_bank(book) -> DataFrame:
    """Active vendors without a bank key, one row per category and bank row."""
    src = book.src
    unbanked = pin(
        _banked(src, _active(), "left")
        .filter(F.col("bank_keys").isNull())
        .withColumn("bank_key", joined_key(*_SHORT_BANK_KEY))
        .distinct(),
        "unbanked",
    )
    areas = _spend_of(src, unbanked).select("supplier_id", L2).distinct()
    rows = unbanked.join(areas, "supplier_id")
    return emit(rows, NO_BANK, "supplier_creation_date", book.today, keep_area=True)


# The fields every vendor record must fill.
LOCAL_MANDATORY = [
    "supplier_name",
    "search_term1",
    "search_term2",
    "street",
    "postal_code",
    "city",
    "state",
    "country",
    "email_address",
    "communication_method",
    "tax_id",
    "industry",
    "bank_country_key",
    "bank_keys",
    "bank_account_number",
    "account_holder_name",
    "contact_first_name",
    "contact_last_name",
    "contact_email",
    "periodic_acc_stat_ind",
    "vendor_clerk",
    "accounting_clerk_telephone",
    "partner_comp_clerk_internet",
    "payment_terms",
    "payment_method",
    "order_currency",
    "minority_indicator",
]
INTERNATIONAL_MANDATORY = [
    *LOCAL_MANDATORY,
    "finance_contact_first_name",
    "finance_contact_last_name",
    "finance_contact_telephone",
    "finance_contact_fax",
    "finance_contact_email",
    "incoterms2",
    "schema_group_vendor",
]


def _contacts(src, function: str, columns: dict[str, str]) -> DataFrame:
    return src.vendor_contact.filter(F.col("function_id") == function).select(
        F.col("vendor").alias("supplier_id"),
        *[F.col(c).alias(n) for c, n in columns.items()],
    )


def _incomplete(book, label: Label, in_country: Column, mandatory: list[str]) -> DataFrame:
    """Active vendors with at least one mandatory field empty in the joined master data.

    The register of payment terms adds no column to the report, so it is not joined.
    """
    src = book.src
    vendors = src.dim_vendor.filter(in_country & _active()).select(
        F.col("vendor").alias("supplier_id"),
        F.col("vendor_description").alias("supplier_name"),
        F.col("date_first_created").alias("supplier_creation_date"),
        "search_term1",
        "search_term2",
        "street",
        "postal_code",
        "city",
        "state",
        "country",
        "email_address",
        "tax_id",
        "industry",
        "address_number",
    )
    international = "incoterms2" in mandatory
    organisation = ["order_currency", "minority_indicator"]
    if international:
        organisation += ["incoterms2", "schema_group_vendor"]

    def by_vendor(df: DataFrame, *columns) -> DataFrame:
        return df.select(F.col("vendor").alias("supplier_id"), *columns)

    lookups = [
        scope_columns(book, F.col("vendor_id").alias("supplier_id"), L2, "payment_terms"),
        by_vendor(src.vendor_bank, *_BANK),
        _contacts(
            src,
            "Z1",
            {
                "first_name": "contact_first_name",
                "last_name": "contact_last_name",
                "email": "contact_email",
            },
        ),
        by_vendor(
            src.vendor_company_code,
            "periodic_acc_stat_ind",
            "vendor_clerk",
            "accounting_clerk_telephone",
            "partner_comp_clerk_internet",
            F.col("payment_method_supp").alias("payment_method"),
        ),
        by_vendor(src.vendor_purch_org, *organisation),
    ]
    if international:
        lookups.append(
            _contacts(
                src,
                "Z3",
                {
                    "first_name": "finance_contact_first_name",
                    "last_name": "finance_contact_last_name",
                    "telephone": "finance_contact_telephone",
                    "fax": "finance_contact_fax",
                    "email": "finance_contact_email",
                },
            )
        )
    rows = vendors.join(src.business_address, "address_number", "left").drop("address_number")
    for lookup in lookups:
        rows = rows.join(lookup, "supplier_id", "left")
    rows = rows.filter(any_missing(mandatory)).distinct()
    return emit(rows, label, "supplier_creation_date", book.today, keep_area=True)


def local_vendors_incomplete(book) -> DataFrame:
    return _incomplete(
        book, LOCAL_INCOMPLETE, F.col("country") == HOME_COUNTRY, LOCAL_MANDATORY
    )


def international_vendors_incomplete(book) -> DataFrame:
    return _incomplete(
        book,
        INTERNATIONAL_INCOMPLETE,
        F.col("country") != HOME_COUNTRY,
        INTERNATIONAL_MANDATORY,
    )
