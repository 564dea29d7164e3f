"""The specs of the sixteen detail tables. Column names, listed values and lookups here are fixed values."""

from __future__ import annotations

from casefeatures.functions import rows as R
from casefeatures.functions.schema import lenient_cast, quoted
from casefeatures.operators.encode import NO_CATEGORY, Category, fitted, valued
from casefeatures.plans.spec import TableSpec

AVERAGED = ("_mean_target", "_frequency")
ORDERED = ("_encoded", "_encoded_last", "_encoded_mode")
WITH_TAIL_MAX = ("tail_mean", "tail_max", "diffmean", "diffstd", "difflast")

# Ranks and numbers given by hand, per column.
GIVEN = {
    "conts_type_509L": {
        "EMPLOYMENT_PHONE": 4, "PRIMARY_MOBILE": 2, "SECONDARY_MOBILE": 3, "ALTERNATIVE_PHONE": 0, "PHONE": 1,
        "HOME_PHONE": 6, "PRIMARY_EMAIL": 5, "SKYPE": 7, "WHATSAPP": 7,
    },
    "credacc_cards_status_52L": {
        "BLOCKED": 0, "RENEWED": 1, "ACTIVE": 2, "UNCONFIRMED": 3, "INACTIVE": 4, "CANCELLED": 5,
    },
    "cacccardblochreas_147M": {
        "P133_119_56": 2, "P127_74_114": 7, "P33_145_161": 5, "P19_60_110": 3, "P201_63_60": 0, "P17_56_144": 1,
        "P41_107_150": 6, "P23_105_103": 4,
    },
    "relationshiptoclient": {
        "SIBLING": 0, "NEIGHBOR": 1, "FRIEND": 2, "OTHER_RELATIVE": 3, "CHILD": 4, "OTHER": 5, "GRAND_PARENT": 6,
        "PARENT": 7, "SPOUSE": 8, "COLLEAGUE": 9,
    },
    "periodicityofpmts_997L": {
        "Взносы с нерегулярной периодичностью": 0, "Ежемесячные платежи - 30 дней": 30,
        "Полугодовые платежи - 180 дней": 180, "Ежеквартальные платежи - 90 дней": 90,
        "В день истечения срока кредитного договора": 365,
    },
    "riskassesment_302T": {
        "6% - 8%": 0.07, "8% - 11%": 0.09, "11% - 15%": 0.13, "67% - 100%": 0.835, "2% - 3%": 0.025,
        "50% - 58%": 0.54, "20% - 25%": 0.235, "59% - 66%": 0.625, "33% - 41%": 0.37, "3% - 4%": 0.035,
        "1% - 1%": 0.05, "2% - 2%": 0.02, "4% - 6%": 0.05, "41% - 49%": 0.45, "15% - 19%": 0.17,
        "26% - 33%": 0.295,
    },
}

# The label each band of risk has in the names of its columns.
RISK_BANDS = {
    "6% - 8%": "0", "8% - 11%": "1", "11% - 15%": "2", "67% - 100%": "3", "2% - 3%": "4", "50% - 58%": "5", "20% - 25%": "6", "59% - 66%": "7",
    "33% - 41%": "8", "3% - 4%": "9", "1% - 1%": "10", "2% - 2%": "11", "4% - 6%": "12", "41% - 49%": "13", "15% - 19%": "14", "26% - 33%": "15",
}

# Columns whose categories are numbered from the data, unknown ones being 0.
INDEXED = {"person_1": ("registaddr_district_1083M",)}

PERSON_2 = TableSpec(
    name="person_2",
    depth=2,
    categories=(
        fitted("relatedpersons_role_762T", "relatedpersons_role", fill=NO_CATEGORY),
        fitted("addres_district_368M", "addres_district"),
        fitted("addres_role_871L", "addres_role", fill=NO_CATEGORY),
        fitted("addres_zip_823M", "addres_zip"),
        fitted("conts_role_79M", "conts_role"),
        fitted("empls_economicalst_849M", "empls_economicalst"),
    ),
    counts=("relatedpersons_role_762T",),
    stats={"relatedpersons_role_762T_encoded_max": ("max", "relatedpersons_role_762T_encoded")},
    first_nonnull=("empls_employedfrom_796D",),
    average_endings=AVERAGED,
    order_endings=("_encoded",),
)

_CARD_COLUMNS = ("conts_type_509L", "credacc_cards_status_52L", "cacccardblochreas_147M")

APPLPREV_2 = TableSpec(
    name="applprev_2",
    depth=2,
    categories=(
        fitted("conts_type_509L", "conts_type", "mf", NO_CATEGORY),
        fitted("credacc_cards_status_52L", "credacc_cards_status", "mf", NO_CATEGORY),
        fitted("cacccardblochreas_147M", None, "mf", NO_CATEGORY),
        *[valued(c, f"{c}_encoded") for c in _CARD_COLUMNS],
    ),
    counts=tuple(f"{c}_encoded" for c in _CARD_COLUMNS),
    stats={f"{c}_encoded_max": ("max", f"{c}_encoded") for c in _CARD_COLUMNS},
    average_endings=AVERAGED,
    order_endings=("_encoded",),
    sequences=True,
)

_GUARANTEE_KINDS = (
    "collater_typofvalofguarant_298M", "collater_typofvalofguarant_407M",
    "collaterals_typeofguarante_359M", "collaterals_typeofguarante_669M",
)
_GUARANTEE_VALUES = ("collater_valueofguarantee_1124L", "collater_valueofguarantee_876L")
_PAST_DUE = ("pmts_dpd_1073P", "pmts_dpd_303P", "pmts_overdue_1140A", "pmts_overdue_1152A")
_PAYMENT_YEARS = ("pmts_year_507T", "pmts_year_1139T")

CREDIT_BUREAU_A_2 = TableSpec(
    name="credit_bureau_a_2",
    depth=2,
    categories=tuple(fitted(c) for c in (*_GUARANTEE_KINDS, "subjectroles_name_541M", "subjectroles_name_838M")),
    counts=(*_GUARANTEE_VALUES, *_PAYMENT_YEARS),
    counts_known=(*_GUARANTEE_KINDS, "subjectroles_name_541M"),
    counts_positive=_PAST_DUE,
    stats={f"{c}_{kind}": (kind, c) for c in (*_GUARANTEE_VALUES, *_PAST_DUE) for kind in ("sum", "mean")}
    | {f"{c}_first": ("min", c) for c in _PAYMENT_YEARS}
    | {f"{c}_last": ("max", c) for c in _PAYMENT_YEARS},
    last_positive={f"{c}_last": c for c in ("pmts_overdue_1140A", "pmts_overdue_1152A")},
    spans={f"{c}_duration": c for c in _PAYMENT_YEARS},
    gaps={"pmts_year_1139T_507T_diff": ("pmts_year_1139T", "pmts_year_507T")},
    average_endings=AVERAGED,
    order_endings=("_encoded",),
    sequences=True,
    sequence_kinds=WITH_TAIL_MAX,
)

_B2_VALUES = ("pmts_dpdvalue_108P", "pmts_pmtsoverdue_635A")

CREDIT_BUREAU_B_2 = TableSpec(
    name="credit_bureau_b_2",
    depth=2,
    counts=("pmts_date_1107D",),
    counts_positive=("pmts_dpdvalue_108P",),
    date_numbers={
        "pmts_date_1107D_first": ("year", "min", "pmts_date_1107D"),
        "pmts_date_1107D_last": ("year", "max", "pmts_date_1107D"),
    },
    span_years={"pmts_date_1107D_duration": "pmts_date_1107D"},
    span_days={"pmts_date_1107D_duration_days": "pmts_date_1107D"},
    stats={f"{c}_max": ("max", c) for c in _B2_VALUES},
    last={f"{c}_last": c for c in _B2_VALUES},
    peaks=_B2_VALUES,
    peak_drops=_B2_VALUES,
    sequences=True,
)

_B1_SUMMARY = (
    "amount_1115A", "totalamount_503A", "totalamount_881A", "overdueamountmax_950A", "interesteffectiverate_369L",
    "interestrateyearly_538L", "pmtdaysoverdue_1135P", "pmtnumpending_403L",
    "pmts_dpdvalue_108P_max", "pmts_dpdvalue_108P_last", "pmts_pmtsoverdue_635A_max", "pmts_pmtsoverdue_635A_last",
)
_B1_SUMS = (
    "installmentamount_833A", "residualamount_3940956A", "credlmt_1052A", "credlmt_228A", "credlmt_3940954A",
    "credquantity_1099L", "credquantity_984L", "instlamount_892A", "debtvalue_227A", "debtpastduevalue_732A",
    "residualamount_127A", "numberofinstls_810L",
)
_B1_MEANS = (
    *_B1_SUMS, "installmentamount_644A", "residualamount_1093A", "dpd_550P", "dpd_733P", "dpdmax_851P",
    "pmts_date_1107D_duration", "pmts_date_1107D_duration_days", "pmts_dpdvalue_108P_pos", "pmts_pmtsoverdue_635A_pos",
)
_B1_MAXIMA = (
    "credquantity_1099L", "credquantity_984L", "maxdebtpduevalodued_3940955A", "dpd_550P", "dpd_733P", "dpdmax_851P",
    "pmts_date_1107D_duration", "pmts_date_1107D_duration_days", "pmts_dpdvalue_108P_maxidx", "pmts_pmtsoverdue_635A_maxidx",
)

CREDIT_BUREAU_B_1 = TableSpec(
    name="credit_bureau_b_1",
    depth=1,
    child="credit_bureau_b_2",
    month_dates={
        "dpdmaxdate_742T_804T": ("dpdmaxdateyear_742T", "dpdmaxdatemonth_804T"),
        "overdueamountmaxdate_432T_494T": ("overdueamountmaxdateyear_432T", "overdueamountmaxdatemonth_494T"),
    },
    categories=(
        Category("periodicityofpmts_997L", (("frequency", "periodicityofpmts_997L_frequency"),), NO_CATEGORY),
        valued("periodicityofpmts_997L", "periodicityofpmts_997L_interval"),
        fitted("periodicityofpmts_997M", fill=NO_CATEGORY),
        *[
            fitted(c)
            for c in (
                "classificationofcontr_1114M", "contractst_516M", "contracttype_653M", "credor_3940957M",
                "pmtmethod_731M", "purposeofcred_722M", "subjectrole_326M", "subjectrole_43M",
            )
        ],
    ),
    counts=_B1_SUMMARY,
    counts_positive=("dpd_550P", "dpd_733P", "dpdmax_851P"),
    positive={
        "max": (*_B1_SUMMARY, *_B1_MAXIMA),
        "sum": (*_B1_SUMMARY, *_B1_SUMS, "num_pmts_date_1107D", "num_pmts_dpdvalue_108P"),
        "mean": (*_B1_SUMMARY, *_B1_MEANS),
        "min": ("maxdebtpduevalodued_3940955A",),
    },
    medians=_B1_SUMMARY,
    any_null=("amount_1115A", "totalamount_881A"),
    row_ratios_zero={"amount_1115A_totalamount_503A_ratio_max": ("max", "amount_1115A", "totalamount_503A")},
    ratios={
        "amount_1115A_credlmt_3940954A_ratio": ("max", "amount_1115A", "credlmt_3940954A"),
        "amount_1115A_credlmt_1052A_ratio": ("max", "amount_1115A", "credlmt_1052A"),
        "totalamount_503A_881A": ("max", "totalamount_503A", "totalamount_881A"),
        "overdueamountmax_950A_installmentamount_833A_ratio": ("max", "overdueamountmax_950A", "installmentamount_833A"),
        "overdueamountmax_950A_instlamount_892A_ratio": ("max", "overdueamountmax_950A", "instlamount_892A"),
        "residualamount_3940956A_credlmt_3940954A_ratio": ("max", "residualamount_3940956A", "credlmt_3940954A"),
        "debtpastduevalue_732A_debtvalue_227A_ratio": ("max", "debtpastduevalue_732A", "debtvalue_227A"),
    },
    row_ratios={
        "amount_1115A_credlmt_3940954A_ratio_max": ("max", "amount_1115A", "credlmt_3940954A"),
        "amount_1115A_credlmt_1052A_ratio_max": ("max", "amount_1115A", "credlmt_1052A"),
        "residualamount_3940956A_credlmt_3940954A_ratio_max": ("max", "residualamount_3940956A", "credlmt_3940954A"),
        "debtpastduevalue_732A_debtvalue_227A_ratio_max": ("max", "debtpastduevalue_732A", "debtvalue_227A"),
    },
    row_gaps={"totalamount_503A_max_diff": ("max", "totalamount_503A", "amount_1115A")},
    row_diffs={
        "credlmt_3940954A_credlmt_228A_diff_max": ("max", "credlmt_3940954A", "credlmt_228A"),
        "credlmt_3940954A_credlmt_1052A_diff_max": ("max", "credlmt_3940954A", "credlmt_1052A"),
    },
    diffs={
        "credlmt_3940954A_credlmt_228A_diff": ("max", "credlmt_3940954A", "credlmt_228A"),
        "credlmt_3940954A_credlmt_1052A_diff": ("max", "credlmt_3940954A", "credlmt_1052A"),
    },
    recent={"maxdebtpduevalodued_3940955A_isrecent": ("maxdebtpduevalodued_3940955A", 120.0)},
    span_days={
        "dpdmaxdate_duration": "dpdmaxdate_742T_804T",
        "overdueamountmaxdat_duration": "overdueamountmaxdate_432T_494T",
    },
    date_numbers={
        "dpdmaxdateyear_742T_last": ("year", "max", "dpdmaxdate_742T_804T"),
        "dpdmaxdatemonth_804T_last": ("month", "max", "dpdmaxdate_742T_804T"),
        "overdueamountmaxdateyear_432T_last": ("year", "max", "overdueamountmaxdate_432T_494T"),
        "overdueamountmaxdatemonth_494T_last": ("month", "max", "overdueamountmaxdate_432T_494T"),
    },
    row_days={f"lastupdate_260D_contractdate_551D_diff_{k}": (k, "lastupdate_260D", "contractdate_551D") for k in ("min", "max", "mean")}
    | {f"contractmaturitydate_151D_lastupdate_260D_diff_{k}": (k, "contractmaturitydate_151D", "lastupdate_260D") for k in ("min", "max", "mean")},
    wide_spans={
        "pmts_date_1107D_duration": ("pmts_date_1107D_last", "pmts_date_1107D_first"),
        "pmts_date_1107D_duration_days": ("pmts_date_1107D_last", "pmts_date_1107D_first"),
    },
    scaled={"pmts_date_1107D_duration_days": 365},
    stats={"pmts_date_1107D_first": ("min", "pmts_date_1107D_first"), "pmts_date_1107D_last": ("max", "pmts_date_1107D_last")},
    average_endings=("_mean_target", "_interval"),
    order_endings=("_encoded",),
    sequences=True,
)

_A1_SUMMARY = ("annualeffectiverate_199L", "annualeffectiverate_63L", "contractsum_5085717L", "interestrate_508L")
_A1_SUMS = (
    "credlmt_230A", "credlmt_935A", "debtoutstand_525A", "debtoverdue_47A", "dpdmax_139P", "dpdmax_757P",
    "instlamount_852A", "instlamount_768A", "monthlyinstlamount_674A", "monthlyinstlamount_332A",
    "numberofcontrsvalue_258L", "numberofcontrsvalue_358L", "numberofinstls_229L", "numberofinstls_320L",
    "numberofoutstandinstls_520L", "numberofoutstandinstls_59L", "numberofoverdueinstlmax_1039L",
    "outstandingamount_354A", "outstandingamount_362A", "overdueamount_31A", "overdueamount_659A",
    "overdueamountmax_155A", "overdueamountmax_35A", "prolongationcount_1120L", "prolongationcount_599L",
    "residualamount_488A", "totalamount_6A", "totalamount_996A", "totaldebtoverduevalue_178A",
    "totaldebtoverduevalue_718A", "totaloutstanddebtvalue_39A", "totaloutstanddebtvalue_668A",
)
_A1_MEANS = (
    *_A1_SUMS, "nominalrate_281L", "nominalrate_498L", "numberofoverdueinstls_725L", "numberofoverdueinstls_834L",
    "periodicityofpmts_1102L", "periodicityofpmts_837L", "residualamount_856A",
)
_A1_MAXIMA = (
    "credlmt_230A", "credlmt_935A", "dpdmax_139P", "dpdmax_757P", "overdueamountmax2_14A", "overdueamountmax2_398A",
    "prolongationcount_1120L", "prolongationcount_599L", "outstandingamount_362A",
)

CREDIT_BUREAU_A_1 = TableSpec(
    name="credit_bureau_a_1",
    depth=1,
    child="credit_bureau_a_2",
    month_dates={
        "overdueamountmaxdate_994T_284T": ("overdueamountmaxdateyear_994T", "overdueamountmaxdatemonth_284T"),
        "overdueamountmaxdate_2T_365T": ("overdueamountmaxdateyear_2T", "overdueamountmaxdatemonth_365T"),
        "dpdmaxdate_896T_442T": ("dpdmaxdateyear_896T", "dpdmaxdatemonth_442T"),
        "dpdmaxdate_596T_89T": ("dpdmaxdateyear_596T", "dpdmaxdatemonth_89T"),
    },
    categories=tuple(
        fitted(c)
        for c in (
            "classificationofcontr_13M", "classificationofcontr_400M", "contractst_545M", "contractst_964M",
            "description_351M", "financialinstitution_382M", "financialinstitution_591M", "purposeofcred_426M",
            "purposeofcred_874M", "subjectrole_182M", "subjectrole_93M",
        )
    ),
    counts=_A1_SUMMARY,
    counts_positive=(
        "dpdmax_139P", "dpdmax_757P", "monthlyinstlamount_674A", "monthlyinstlamount_332A", "numberofoutstandinstls_520L",
        "numberofoutstandinstls_59L", "numberofoverdueinstlmax_1151L", "numberofoverdueinstls_725L",
        "numberofoverdueinstls_834L", "dateofcredend_353D", "dateofcredend_289D",
    ),
    positive={
        "max": (*_A1_SUMMARY, *_A1_MAXIMA),
        "sum": (*_A1_SUMMARY, *_A1_SUMS),
        "mean": (*_A1_SUMMARY, *_A1_MEANS),
        "std": ("nominalrate_281L", "nominalrate_498L", "residualamount_856A", "residualamount_488A"),
    },
    diffs={
        "annualeffectiverate_63L_199L_sum_diff": ("sum", "annualeffectiverate_63L", "annualeffectiverate_199L"),
        "annualeffectiverate_63L_199L_mean_diff": ("mean", "annualeffectiverate_63L", "annualeffectiverate_199L"),
        "credlmt_935A_1230A_sum_diff": ("sum", "credlmt_935A", "credlmt_230A"),
        "credlmt_935A_230A_mean_diff": ("mean", "credlmt_935A", "credlmt_230A"),
        "nominalrate_281L_498L_mean_diff": ("mean", "nominalrate_281L", "nominalrate_498L"),
        "contractsum_5085717L_mean_diff": ("mean", "contractsum_5085717L", "contractsum_5085717L"),
        "dpdmax_139P_757P_mean_diff": ("mean", "dpdmax_139P", "dpdmax_757P"),
        "instlamount_768A_852A_diff": ("sum", "instlamount_768A", "instlamount_852A"),
        "monthlyinstlamount_332A_674A_diff": ("sum", "monthlyinstlamount_332A", "monthlyinstlamount_674A"),
    },
    ratios={
        "debtoverdue_47A_debtoutstand_525A_ratio": ("sum", "debtoverdue_47A", "debtoutstand_525A"),
        "debtoutstand_525A_credlmt_935A_ratio": ("sum", "debtoutstand_525A", "credlmt_935A"),
        "instlamount_852A_768A_ratio": ("sum", "instlamount_852A", "instlamount_768A"),
        "monthlyinstlamount_332A_674A_ratio": ("sum", "monthlyinstlamount_332A", "monthlyinstlamount_674A"),
        "numberofinstls_320L_229L_sum_ratio": ("sum", "numberofinstls_320L", "numberofinstls_229L"),
        "numberofinstls_320L_229L_mean_ratio": ("mean", "numberofinstls_320L", "numberofinstls_229L"),
        "numberofoutstandinstls_59L_numberofinstls_320L_ratio": ("sum", "numberofoutstandinstls_59L", "numberofinstls_320L"),
        "numberofoutstandinstls_520L_numberofinstls_229L_ratio": ("sum", "numberofoutstandinstls_520L", "numberofinstls_229L"),
        "numberofoverdueinstlmax_1039L_numberofinstls_320L_ratio": ("sum", "numberofoverdueinstlmax_1039L", "numberofinstls_320L"),
        "numberofoverdueinstlmax_1151L_numberofinstls_229L_ratio": ("sum", "numberofoverdueinstlmax_1151L", "numberofinstls_229L"),
        "numberofoverdueinstls_725L_numberofinstls_320L_ratio": ("sum", "numberofoverdueinstls_725L", "numberofinstls_320L"),
        "numberofoverdueinstls_834L_numberofinstls_229L_ratio": ("sum", "numberofoverdueinstls_834L", "numberofinstls_229L"),
        "outstandingamount_354A_credlmt_230A_ratio": ("sum", "outstandingamount_354A", "credlmt_230A"),
        "outstandingamount_362A_credlmt_935A_ratio": ("sum", "outstandingamount_362A", "credlmt_935A"),
        "overdueamount_31A_outstandingamount_354A_ratio": ("sum", "overdueamount_31A", "outstandingamount_354A"),
        "overdueamount_659A_outstandingamount_362A_ratio": ("sum", "overdueamount_659A", "outstandingamount_362A"),
        "residualamount_856A_488A_ratio": ("sum", "residualamount_856A", "residualamount_488A"),
        "residualamount_856A_credlmt_935A_ratio": ("sum", "residualamount_856A", "credlmt_935A"),
        "residualamount_488A_credlmt_230A_ratio": ("sum", "residualamount_488A", "credlmt_230A"),
    },
    shares={"totalamount_6A_totalamount_996A_ratio": ("totalamount_6A", "totalamount_996A")},
    row_days={f"dateofcredend_353D_dateofcredstart_181D_diff_{k}": (k, "dateofcredend_353D", "dateofcredstart_181D") for k in ("mean", "max", "min")}
    | {f"dateofcredend_289D_dateofcredstart_739D_diff_{k}": (k, "dateofcredend_289D", "dateofcredstart_739D") for k in ("mean", "max", "min", "std")}
    | {f"dateofcredend_353D_dateofrealrepmt_138D_{n}": (k, "dateofcredend_353D", "dateofrealrepmt_138D") for n, k in (("diff", "mean"), ("max", "max"), ("min", "min"), ("std", "std"))}
    | {
        "dateofcredend_353D_numberofoverdueinstlmaxdat_148D_diff": ("min", "dateofcredend_353D", "numberofoverdueinstlmaxdat_148D"),
        "dateofcredend_289D_numberofoverdueinstlmaxdat_641D_diff": ("min", "dateofcredend_289D", "numberofoverdueinstlmaxdat_641D"),
        "dateofcredend_353D_overdueamountmax2date_1002D_diff": ("min", "dateofcredend_353D", "overdueamountmax2date_1002D"),
        "dateofcredend_289D_overdueamountmax2date_1142D_diff": ("min", "dateofcredend_289D", "overdueamountmax2date_1142D"),
        "dateofcredend_353D_overdueamountmaxdate_994T_284T_diff": ("min", "dateofcredend_353D", "overdueamountmaxdate_994T_284T"),
        "dateofcredend_289D_overdueamountmaxdate_2T_365T_diff": ("min", "dateofcredend_289D", "overdueamountmaxdate_2T_365T"),
        "overdueamountmaxdate_2T_365T_refreshed_last": ("min", "refreshdate_3813885D", "overdueamountmaxdate_2T_365T"),
        "overdueamountmaxdate_2T_365T_refreshed_mean": ("mean", "refreshdate_3813885D", "overdueamountmaxdate_2T_365T"),
        "dateofcredend_353D_dpdmaxdate_896T_442T_diff": ("min", "dateofcredend_353D", "dpdmaxdate_896T_442T"),
        "dateofcredend_289D_dpdmaxdate_596T_89T_diff": ("min", "dateofcredend_289D", "dpdmaxdate_596T_89T"),
        "dpdmaxdateyear_596T_89T_refreshed_last": ("min", "refreshdate_3813885D", "dpdmaxdate_596T_89T"),
        "dpdmaxdateyear_596T_89T_refreshed_mean": ("mean", "refreshdate_3813885D", "dpdmaxdate_596T_89T"),
        "dateofcredend_289D_refreshdate_3813885D_diff_mean": ("mean", "dateofcredend_289D", "refreshdate_3813885D"),
        "dateofcredend_289D_refreshdate_3813885D_diff_std": ("std", "dateofcredend_289D", "refreshdate_3813885D"),
        "refreshdate_3813885D_lastupdate_1112D_diff_mean": ("mean", "refreshdate_3813885D", "lastupdate_1112D"),
        "refreshdate_3813885D_lastupdate_388D_diff_mean": ("mean", "refreshdate_3813885D", "lastupdate_388D"),
        "refreshdate_3813885D_lastupdate_388D_diff_min": ("min", "refreshdate_3813885D", "lastupdate_388D"),
    },
    group_days={
        f"refreshdate_3813885D_{c}_diff": ("refreshdate_3813885D", c)
        for c in ("numberofoverdueinstlmaxdat_148D", "numberofoverdueinstlmaxdat_641D", "overdueamountmax2date_1002D", "overdueamountmax2date_1142D")
    },
    days_norm={
        f"dateofcredend_289D_refreshdate_3813885D_diff_{k}_norm": (k, "dateofcredend_289D", "refreshdate_3813885D", "dateofcredend_289D", "dateofcredstart_739D")
        for k in ("mean", "std")
    },
    dates={
        f"{c}_mean": ("mean", c)
        for c in (
            "dateofcredstart_739D", "dateofcredstart_181D", "dateofrealrepmt_138D", "dateofcredend_353D",
            "numberofoverdueinstlmaxdat_641D", "overdueamountmax2date_1002D", "dateofcredend_289D",
        )
    }
    | {
        f"{c}_max": ("max", c)
        for c in (
            "dateofcredend_353D", "dateofcredstart_181D", "overdueamountmax2date_1142D",
            "numberofoverdueinstlmaxdat_148D", "refreshdate_3813885D",
        )
    },
    span_days={"refreshdate_3813885D_diff": "refreshdate_3813885D"},
    date_std={"refreshdate_3813885D_std": "refreshdate_3813885D"},
    average_endings=("_mean_target",),
    order_endings=ORDERED,
    name_rules=True,
    sequences=True,
)

_PERSON_TYPES = ("1.0", "4.0", "5.0")
_EMPLOYED_TOTAL = ("MORE_FIVE", "LESS_ONE", "MORE_ONE")
_UNSTABLE_INDUSTRIES = (
    "CHARITY_RELIGIOUS", "GAMING", "RECRUITMENT", "WELNESS", "TOURISM", "AGRICULTURE", "TRADE", "REAL_ESTATE",
)


def _person_result() -> dict:
    def flag(c: str, missing: int | None = None):
        out = lenient_cast(quoted(c), "smallint")
        return out if missing is None else R.fill_null(out, missing)

    return {
        "childnum_185L": lenient_cast(lenient_cast(quoted("childnum_185L"), "double"), "smallint"),
        "empl_industry_691L_unstable": R.in_list_flag(quoted("empl_industry_691L"), _UNSTABLE_INDUSTRIES),
        "sex_738L": R.remap_values(quoted("sex_738L"), {"F": 0, "M": 1}, -1),
        **{c: R.digits_to_int(quoted(c)) for c in ("contaddr_district_15M", "contaddr_zipcode_807M", "empladdr_zipcode_114M")},
        **{c: flag(c) for c in ("contaddr_matchlist_1032L", "contaddr_smempladdr_334L")},
        **{c: flag(c, -1) for c in ("remitter_829L", "safeguarantyflag_411L")},
        "empl_employedfrom_271D_isemployed": quoted("empl_employedfrom_271D").isNotNull().cast("int"),
        "empls_employedfrom_796D_271D": R.latest_of_columns(quoted("empls_employedfrom_796D"), quoted("empl_employedfrom_271D")),
        "birth_259D_87D": R.latest_of_columns(quoted("birth_259D"), quoted("birthdate_87D")),
    }


PERSON_1 = TableSpec(
    name="person_1",
    depth=1,
    child="person_2",
    split_first=("contaddr_district_15M", "contaddr_zipcode_807M", "empladdr_zipcode_114M"),
    one_hot={
        "persontype_1072L": {v: v for v in _PERSON_TYPES},
        "persontype_792L": {v: v for v in _PERSON_TYPES},
        "empl_employedtotal_800L": {v: v for v in _EMPLOYED_TOTAL},
        "language1_981M": {v: v for v in ("P209_127_106", "P10_39_147")},
    },
    categories=(
        valued("relationshiptoclient_415T", "relationshiptoclient_415T_encoded", fitted_on="relationshiptoclient"),
        valued("relationshiptoclient_642T", "relationshiptoclient_642T_encoded", fitted_on="relationshiptoclient"),
        fitted("contaddr_district_15M"),
        fitted("contaddr_zipcode_807M"),
        fitted("empladdr_zipcode_114M"),
        fitted("education_927M"),
        fitted("empladdr_district_926M"),
        *[
            fitted(c, fill=NO_CATEGORY)
            for c in ("empl_employedtotal_800L", "empl_industry_691L", "familystate_447L", "incometype_1044T", "language1_981M", "type_25L")
        ],
        fitted("maritalst_703L", kinds="o", fill=NO_CATEGORY, fitted_on="familystate_447L"),
        *[fitted(c, kinds="mo", fill=NO_CATEGORY) for c in ("housetype_905L", "housingtype_772L", "role_1084L")],
        valued("registaddr_district_1083M", "registaddr_district_1083M", default=0),
    ),
    mixed={"housetype_905L_772L_mean_target": ("housetype_905L_mean_target", "housingtype_772L_mean_target")},
    drop=("housetype_905L_mean_target",),
    counts=("personindex_1023L", "type_25L"),
    counts_of={
        "persontype_1072L": {v: f"persontype_{v}_1072L" for v in _PERSON_TYPES},
        "persontype_792L": {v: f"persontype_{v}_792L" for v in _PERSON_TYPES},
        "empl_employedtotal_800L": {v: f"employedtotal_{v}_800L" for v in _EMPLOYED_TOTAL},
    },
    counts_null={"persontype_1072L": "persontype_null_1072L", "persontype_792L": "persontype_null_792L"},
    first=(
        "childnum_185L", "empl_industry_691L", "contaddr_district_15M", "contaddr_zipcode_807M", "empladdr_zipcode_114M",
        "registaddr_district_1083M",
    ),
    first_nonnull=(
        "sex_738L", "contaddr_matchlist_1032L", "contaddr_smempladdr_334L", "empl_employedfrom_271D", "mainoccupationinc_384A",
        "remitter_829L", "safeguarantyflag_411L", "empls_employedfrom_796D",
    ),
    dates={"birth_259D": ("max", "birth_259D"), "birthdate_87D": ("max", "birthdate_87D")},
    stats={
        "num_relatedpersons_role_762T_encoded_max": ("sum", "relatedpersons_role_762T_encoded_max"),
        "relatedpersons_role_762T_encoded_max": ("max", "relatedpersons_role_762T_encoded_max"),
    },
    average_endings=("_mean_target",),
    order_endings=ORDERED,
    result=_person_result,
    result_drop=("empl_industry_691L", "empls_employedfrom_796D", "empl_employedfrom_271D", "birth_259D", "birthdate_87D"),
)

_APPLPREV_SUMS = ("actualdpd_943P", "annuity_853A", "credacc_transactions_402L", "credamount_590A", "currdebt_94A")
_INCOMES = ("byoccupationinc_3656910L", "mainoccupationinc_437A")

APPLPREV_1 = TableSpec(
    name="applprev_1",
    depth=1,
    child="applprev_2",
    one_hot={"credtype_587L": {v: v for v in ("REL", "CAL", "COL")}},
    categories=(
        *[fitted(c) for c in ("cancelreason_3545846M", "education_1138M", "postype_4733339M", "rejectreason_755M", "rejectreasonclient_4145042M")],
        *[fitted(c, fill=NO_CATEGORY) for c in ("credacc_status_367L", "familystate_726L", "inittransactioncode_279L", "status_219L")],
        fitted("credtype_587L", kinds="mf", fill=NO_CATEGORY),
    ),
    counts=("pmtnum_8L", "dtlastpmtallstes_3545839D"),
    counts_positive=("actualdpd_943P", "annuity_853A", "downpmt_134A", "isbidproduct_390L", "isdebitcard_527L"),
    counts_above={"num_late_actualdpd_943P": ("actualdpd_943P", 30.0)},
    counts_of={"credtype_587L": {v: f"credtype_{v}_587L" for v in ("REL", "CAL", "COL")}},
    positive={
        "max": (
            "pmtnum_8L", "actualdpd_943P", "annuity_853A", "credacc_maxhisbal_375A", "credacc_minhisbal_90A", "currdebt_94A",
            "downpmt_134A", "mainoccupationinc_437A", "maxdpdtolerance_577P",
        ),
        "sum": ("pmtnum_8L", *_APPLPREV_SUMS),
        "mean": ("pmtnum_8L", *_APPLPREV_SUMS, "downpmt_134A", "revolvingaccount_394A", "tenor_203L", "maxdpdtolerance_577P"),
    },
    null_values={"byoccupationinc_3656910L": 1.0},
    row_ratios={
        f"{a}_{b}_ratio_{k}": (k, a, b)
        for a, b, kinds in (
            ("annuity_853A", "byoccupationinc_3656910L", ("mean", "max")),
            ("annuity_853A", "mainoccupationinc_437A", ("mean", "max")),
            ("credacc_actualbalance_314A", "credacc_credlmt_575A", ("mean", "max")),
            ("credacc_actualbalance_314A", "byoccupationinc_3656910L", ("mean", "max")),
            ("credacc_actualbalance_314A", "mainoccupationinc_437A", ("mean",)),
            ("credacc_actualbalance_314A", "credamount_590A", ("mean", "max")),
            ("outstandingdebt_522A", "credacc_credlmt_575A", ("mean", "max")),
        )
        for k in kinds
    },
    rises={"mainoccupationinc_437A_increase": "mainoccupationinc_437A"},
    last_nonnull={f"{c}_last": c for c in ("annuity_853A", "pmtnum_8L", "approvaldate_319D", "credacc_actualbalance_314A")},
    stats={"childnum_21L_max": ("max", "childnum_21L")} | {f"{c}_encoded_max": ("max", f"{c}_encoded_max") for c in _CARD_COLUMNS},
    span_days={"approvaldate_319D_duration": "approvaldate_319D"},
    dates={
        f"{c}_last": ("max", c)
        for c in (
            "creationdate_885D", "dateactivated_425D", "dtlastpmt_581D", "dtlastpmtallstes_3545839D",
            "firstnonzeroinstldate_307D", "employedfrom_700D",
        )
    }
    | {"employedfrom_700D_first": ("min", "employedfrom_700D")},
    row_days={"firstnonzeroinstldate_307D_dtlastpmtallstes_3545839D_diff": ("mean", "dtlastpmtallstes_3545839D", "firstnonzeroinstldate_307D")},
    scaled={"approvaldate_319D_duration": 1.0 / 30, "firstnonzeroinstldate_307D_dtlastpmtallstes_3545839D_diff": 1.0 / 30},
    average_endings=("_mean_target",),
    order_endings=ORDERED,
    sequences=True,
)

DEBITCARD_1 = TableSpec(
    name="debitcard_1",
    depth=1,
    counts_positive=("last180dayaveragebalance_704A",),
    stats={f"{c}_sum": ("sum", c) for c in ("last180dayaveragebalance_704A", "last180dayturnover_1134A", "last30dayturnover_651A")},
    row_ratios={
        f"{a}_last180dayturnover_1134A_ratio_{k}": (k, a, "last180dayturnover_1134A")
        for a in ("last180dayaveragebalance_704A", "last30dayturnover_651A")
        for k in ("max", "mean")
    },
    scaled={f"last30dayturnover_651A_last180dayturnover_1134A_ratio_{k}": 6.0 for k in ("max", "mean")},
    dates={"openingdate_857D_last": ("max", "openingdate_857D"), "openingdate_857D_first": ("min", "openingdate_857D")},
    sequences=True,
)

DEPOSIT_1 = TableSpec(
    name="deposit_1",
    depth=1,
    counts=("contractenddate_991D",),
    counts_positive=("amount_416A",),
    counts_zero=("amount_416A",),
    counts_both={"num_open_nonzero_deposits_416A": ("contractenddate_991D", "amount_416A")},
    stats={"amount_416A_sum": ("sum", "amount_416A")},
    where={
        "amount_416A_stillopen_sum": ("sum", "amount_416A", "contractenddate_991D"),
        "openingdate_313D_first": ("min", "openingdate_313D", "contractenddate_991D"),
        "openingdate_313D_last": ("max", "openingdate_313D", "contractenddate_991D"),
    },
    row_days={"contractenddate_991D_openingdate_313D_duration": ("mean", "contractenddate_991D", "openingdate_313D")},
    scaled={"contractenddate_991D_openingdate_313D_duration": 1.0 / 365},
    sequences=True,
)

TAX_REGISTRY_A_1 = TableSpec(
    name="tax_registry_a_1",
    depth=1,
    counts_positive=("amount_4527230A",),
    stats={f"amount_4527230A_{k}": (k, "amount_4527230A") for k in ("sum", "mean")},
    first_last={"amount_4527230A_first_last_ratio": "amount_4527230A"},
    dates={"recorddate_4527225D": ("max", "recorddate_4527225D")},
    sequences=True,
)

TAX_REGISTRY_B_1 = TableSpec(
    name="tax_registry_b_1",
    depth=1,
    counts_positive=("amount_4917619A",),
    stats={f"amount_4917619A_{k}": (k, "amount_4917619A") for k in ("sum", "mean")},
    dates={"deductiondate_4917603D_last": ("max", "deductiondate_4917603D")},
    span_days={"deductiondate_4917603D_duration": "deductiondate_4917603D"},
    sequences=True,
)

TAX_REGISTRY_C_1 = TableSpec(
    name="tax_registry_c_1",
    depth=1,
    counts_positive=("pmtamount_36A",),
    stats={f"pmtamount_36A_{k}": (k, "pmtamount_36A") for k in ("sum", "mean", "max")},
    dates={"processingdate_168D_last": ("max", "processingdate_168D")},
    span_days={"processingdate_168D_duration": "processingdate_168D"},
    sequences=True,
)

_OTHER = (
    "amtdebitincoming_4809443A", "amtdebitoutgoing_4809440A", "amtdepositbalance_4809441A", "amtdepositincoming_4809444A",
    "amtdepositoutgoing_4809442A",
)

OTHER_1 = TableSpec(
    name="other_1",
    depth=1,
    stats={c: ("sum", c) for c in _OTHER},
    ratios={
        f"{a}_{b}_ratio": ("sum", a, b)
        for a, b in (
            ("amtdebitincoming_4809443A", "amtdebitoutgoing_4809440A"),
            ("amtdepositincoming_4809444A", "amtdepositoutgoing_4809442A"),
            ("amtdepositbalance_4809441A", "amtdebitincoming_4809443A"),
        )
    },
    sequences=True,
)

_STATIC_REASONS = (
    "lastapprcommoditycat_1041M", "lastapprcommoditytypec_5251766M", "lastcancelreason_561M", "lastrejectcommoditycat_161M",
    "lastrejectcommodtypec_5251769M", "lastrejectreason_759M", "lastrejectreasonclient_4145040M", "previouscontdistrict_112M",
)

STATIC_0 = TableSpec(
    name="static_0",
    depth=0,
    flags={
        "bankacctype_710L": ("bankacctype_710L", "CA"),
        "paytype1st_925L": ("paytype1st_925L", "OTHER"),
        "paytype_783L": ("paytype_783L", "OTHER"),
        "twobodfilling_608L_BO": ("twobodfilling_608L", "BO"),
        "twobodfilling_608L_FO": ("twobodfilling_608L", "FO"),
        "typesuite_864L": ("typesuite_864L", "AL"),
    },
    one_hot={
        "cardtype_51L": {v: v for v in ("PERSONALIZED", "INSTANT")},
        "credtype_322L": {v: v for v in ("REL", "CAL", "COL")},
    },
    bools=(
        "equalitydataagreement_891L", "equalityempfrom_62L", "isbidproduct_1095L", "isbidproductrequest_292L", "isdebitcard_729L",
        "opencred_647L",
    ),
    lenient_endings=("A", "P", "L"),
    categories=(
        *[fitted(c, kinds="m", fill=NO_CATEGORY) for c in ("credtype_322L", "cardtype_51L")],
        *[fitted(c, kinds="mo", fill=NO_CATEGORY) for c in ("disbursementtype_67L", "inittransactioncode_186L", "lastst_736L")],
        *[fitted(c, kinds="mo") for c in _STATIC_REASONS],
    ),
    drop=(
        "twobodfilling_608L", "cardtype_51L", "disbursementtype_67L", "inittransactioncode_186L", "lastst_736L", "credtype_322L",
        *_STATIC_REASONS,
    ),
)

_CB_DATES = {
    "dateofbirth_574D_337D_342D": ("birthdate_574D", "dateofbirth_337D", "dateofbirth_342D"),
    "assignmentdate_238D_4527235D_4955616D": ("assignmentdate_238D", "assignmentdate_4527235D", "assignmentdate_4955616D"),
    "responsedate_1012D_4527233D_4917613D": ("responsedate_1012D", "responsedate_4527233D", "responsedate_4917613D"),
}
_CB_WORDS = ("education_1103M", "education_88M", "maritalst_385M", "maritalst_893M")

STATIC_CB_0 = TableSpec(
    name="static_cb_0",
    depth=0,
    latest=_CB_DATES,
    flags={f"description_5085714M_{v}": ("description_5085714M", v) for v in ("2fc785b2", R.MISSING)},
    one_hot={"riskassesment_302T": RISK_BANDS},
    one_hot_fill=NO_CATEGORY,
    lenient_endings=("A", "P", "L", "riskassesment_940T"),
    categories=(
        fitted("requesttype_4525192L", fill=NO_CATEGORY),
        *[fitted(c, kinds="mo") for c in _CB_WORDS],
        fitted("riskassesment_302T", kinds="m", fill=NO_CATEGORY),
        valued("riskassesment_302T", "riskassesment_302T_probability"),
    ),
    days={"assignmentdate_238D_responsedate_1012D_duration": ("assignmentdate_238D_4527235D_4955616D", "responsedate_1012D_4527233D_4917613D")},
    ages={"age": ("assignmentdate_238D_4527235D_4955616D", "dateofbirth_574D_337D_342D", (25, 35, 45, 60))},
    drop=(
        *[c for of in _CB_DATES.values() for c in of],
        "description_5085714M", "requesttype_4525192L", *_CB_WORDS, "riskassesment_302T",
    ),
)

SPECS = {
    s.name: s
    for s in (
        PERSON_2, APPLPREV_2, CREDIT_BUREAU_A_2, CREDIT_BUREAU_B_2, CREDIT_BUREAU_B_1, CREDIT_BUREAU_A_1, PERSON_1, APPLPREV_1,
        DEBITCARD_1, DEPOSIT_1, TAX_REGISTRY_A_1, TAX_REGISTRY_B_1, TAX_REGISTRY_C_1, OTHER_1, STATIC_0, STATIC_CB_0,
    )
}

# Order in which the roll-ups are joined to the base.
JOIN_ORDER = (
    "credit_bureau_b_1", "credit_bureau_a_1", "person_1", "applprev_1", "debitcard_1", "deposit_1", "tax_registry_a_1",
    "tax_registry_b_1", "tax_registry_c_1", "other_1", "static_0", "static_cb_0",
)

# Columns dropped from the wide table: categories of places, columns of one value, endings.
PLACE_COLUMNS = (
    "previouscontdistrict_112M_encoded", "contaddr_zipcode_807M_encoded_mode", "contaddr_zipcode_807M_encoded_last",
    "contaddr_district_15M_encoded_last", "contaddr_district_15M_encoded_mode", "contaddr_district_15M_mean_target",
    "previouscontdistrict_112M_mean_target", "contaddr_zipcode_807M_mean_target", "empladdr_district_926M_encoded_last",
    "empladdr_district_926M_encoded_mode", "empladdr_zipcode_114M_encoded_mode", "empladdr_zipcode_114M_encoded_last",
)
ONE_VALUE_COLUMNS = (
    "amount_1115A_credlmt_3940954A_ratio_max", "amount_1115A_credlmt_1052A_ratio_max", "residualamount_488A_std",
    "persontype_1.0_792L", "deferredmnthsnum_166L",
)
DROPPED_ENDINGS = (
    "_mean_target", "_encoded_mode", "_encoded_mode_last", "_encoded_mode_mode", "_encoded_last_mode", "_encoded_max_mode",
)

# Columns that models take as categories, by ending.
CATEGORY_ENDINGS = ("_encoded", "_encoded_last", "_encoded_mode")
