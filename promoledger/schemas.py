"""Declared table contracts. Codes are strings, money and volumes are double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHORT = {
    "s": T.StringType(),
    "d": T.DoubleType(),
    "i": T.IntegerType(),
    "l": T.LongType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
}


def struct(**groups: str) -> T.StructType:
    """``struct(s="a b", d="c")`` -> columns a, b string and c double, in that order."""
    fields = []
    for group, names in groups.items():
        kind = _SHORT[group.split("_")[0]]
        fields += [T.StructField(name, kind) for name in names.split()]
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a contract: its columns, its order, its types; missing columns become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all text: how a file is read whose values are still to be judged."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _read_as(text: Column, kind: T.DataType) -> Column:
    """The value of a text, null where it is none of that type; whole numbers may be written with decimals."""
    if isinstance(kind, T.IntegerType):
        number = F.trim(text).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def judged(text: DataFrame, schema: T.StructType, keys: Sequence[str] = (), damaged: Column | None = None) -> DataFrame:
    """Text rows with ``typed``, what they hold under the contract, and ``reasons`` against them, in one projection.

    A reason is a column whose text is no value of its type, a key column without
    text, or a line that is ``damaged`` as a whole. Empty text is a missing value.
    """
    typed, reasons = [], []
    for f in schema:
        given = F.when(F.trim(F.col(f.name)) != "", F.col(f.name))
        value = _read_as(given, f.dataType)
        typed.append(value.alias(f.name))
        reasons.append(F.when(given.isNotNull() & value.isNull(), F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), given)))
        if f.name in keys:
            reasons.append(F.when(given.isNull(), F.lit(f"{f.name} is missing")))
    if damaged is not None:
        reasons.insert(0, F.when(damaged, F.lit("wrong number of fields")))
    return text.select("*", F.struct(*typed).alias("typed"), F.array_compact(F.array(*reasons)).alias("reasons"))


# Names and types below are fixed by the contracts of the files and facts.

PROMO_FEED = struct(
    s="country calendar_year calendar_month calendar_day distributor site outlet billing_document "
    "billing_type billing_item product promotion_id promotion_desc1 promo_start_date promo_end_date "
    "promotion_type value_based_promo_disc header_lvl_disc free_qty_in_cs free_qty_in_pc "
    "free_qty_val_in_cs free_qty_val_in_pc free_qty_retail_price_pc free_qty_retail_price_cs"
)

CONTROL_TOTALS = struct(
    s="calendar_day site_code distributor_type value_based_promo_disc header_lvl_disc free_qty_in_cs free_qty_in_pc"
)

PROCESSED_PROMO = struct(
    s="country calendar_day distributor_code site_code outlet_code invoice_no invoice_category billing_item "
    "product_code promotion_id IO promotion_mechanism promotion_desc promo_start_date promo_end_date promotion_type",
    d="value_based_promo_disc header_lvl_disc free_qty_in_cs free_qty_in_pc free_qty_val_in_cs free_qty_val_in_pc "
    "free_qty_retail_price_pc free_quantity_value promotion_value",
    i="on_off_flag year_id month_id time_key",
)

DAILY_PROMOTIONS = struct(
    s="invoice_number product_code standard_product_group_code promotion_id IO promotion_mechanism promotion_desc "
    "promotion_type budget_holder_group invoice_type",
    date="promo_start_date promo_end_date",
    d="value_based_promo_disc header_lvl_disc free_quantity_value promotion_value",
    s_2="distributor_code site_code outlet_code channel banded gift_price_available country",
    i="year_id month_id time_key",
)

MONTHLY_PROMOTIONS = struct(
    s="distributor_code site_code outlet_code product_code channel region standard_product_group_code banded "
    "promotion_type promotion_mechanism promotion_id budget_holder_group invoice_type",
    i="banded_code perfect_store_status_code channel_code region_code",
    s_2="store_size_code gift_price_available",
    d="promotion_value tot_occdis tot_perstr tot_display tot_ltyprg",
    i_2="has_occdis has_perstr has_occdis_and_perstr has_occdis_or_perstr year_id month_id time_key",
)

SALES_VALUES = (
    "gross_sales_val gross_sales_val_mn net_invoice_val gross_sales_return_val sales_return_val "
    "on_invoice_discount_val value_added_tax off_inv_discount_val turn_over_val sales_cs_vol sales_kg_vol "
    "sales_lt_vol"
).split()
SALES_QUANTITIES = "sales_with_return_pc_qty sales_return_pc_qty sales_pc_qty free_pc_qty".split()
SALES_MEASURES = SALES_VALUES + SALES_QUANTITIES

DAILY_SALES = struct(
    s="country_code product_code invoice_number site_code_year transactional_distributor_code "
    "transactional_site_code transactional_outlet_code",
    date="invoice_date",
    s_2="transactional_salesman_code invoicetype customer_ZRSS_flag sales_ret_ref_invoice_number",
    d=" ".join(SALES_VALUES),
    i=" ".join(SALES_QUANTITIES),
    s_3="salesforce brand category_code brand_cat_core",
    ts="insert_ts update_ts",
    # Which backfill brought the row; daily loads bring none.
    s_4="batch_id",
    i_2="year_id month_id time_key",
)

MONTHLY_SALES = struct(
    s="country_code product_code standard_product_group_code region invoice_number site_code_year "
    "transactional_distributor_code transactional_site_code transactional_outlet_code",
    i="channel_code store_size_code perfect_store_status_code region_code banded_code",
    date="invoice_date",
    s_2="transactional_salesman_code invoicetype customer_ZRSS_flag",
    d=" ".join(SALES_VALUES),
    l=" ".join(SALES_QUANTITIES),
    s_3="salesforce brand category_code brand_cat_core banded",
    i_2="year_id month_id time_key",
)

_PH = " ".join(f"PH{n}_code PH{n}_description" for n in range(1, 10))

ARTICLE_MASTER = struct(
    s="material_code material_desc param1",
    d="price_per_su",
    s_2="su_type",
    i="PC_per_SU",
    s_3="cs_type",
    i_2="PC_per_CS",
    s_4=f"pc_type creation_date param2 param3 {_PH} site param4 param5 status",
)

BUDGET_HOLDER = struct(s="budget_holder budget_holder_grp")

GIFT_MASTER = struct(
    s="gift_code gift_name gift_type_name gift_type_code gift_group",
    i="packing_per_case",
    s_2="UOM",
    i_2="remaining_sl_policy",
    s_3="color",
    d="size_h size_w size_l grossweight_per_case_kg netweight_per_pc_gm dimension_per_case_h dimension_per_case_w",
    s_4="description enabled vat",
)

IO_MASTER = struct(
    s="promotion_id promotion_status fund_type promotion_name created_date start_date end_date sellout_start_date "
    "sellout_end_date creator_id budget_holder spend_type investment_type brand_code",
    d="brand_percentage brand_investment investment_amount",
    s_2="customer_code",
    d_2="account_allocation_percentage account_investment_per_brand",
    s_3="sales_organisation_id",
)

LOCAL_PRODUCT_FILE = struct(
    s="material PH9 PH_desc PH7 CD_DP_name portfolio pack_size pack_group brand_variant sub_brand brand segment "
    "CCBT Small_C Big_C CD_View_1 CD_View_2"
)

SPLIT_CATEGORIES = "Fabsol Fabsen HNH Hair Skincare Skincleansing Oral Savoury Tea".split()
PROMOTION_SPLIT = struct(s="year quarter channel", d=" ".join(SPLIT_CATEGORIES))

OUTLET_MAP = struct(s="date old_outlet_code master_outlet_code master_distributor_code master_site_code")

RAW_INVOICE_LINES = struct(
    s="CountryCode ArticleCode InvoiceNumber SiteCode DistributorCode OutletCode SalesmanCode InvoiceType "
    "CustomerZRSSFlag SalesReturnReferenceInvoiceNumber",
    date="InvoiceDate",
    s_2="GrossSalesValue NetInvoiceValue GrossSalesWithReturnValue SalesReturnValue OnInvoiceDiscountValue "
    "ValueAddedTax OffInvoiceDiscountValue TurnoverValue SalesWithReturnPCQuantity SalesReturnPCQuantity "
    "SalesPCQuantity SalesCSVolume SalesKGVolume SalesLTVolume FreePCQuantity",
    ts="BDLLoadTimestamp BDLUpdateTimestamp",
    s_3="YYYY MM DD",
)
