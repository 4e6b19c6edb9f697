"""Sentences, instructions and catalogues the rules are known by.

Holes in braces are filled with columns by ``ledgerloom.functions.text.fill``.
"""

# The sentence each decision is explained with.
REASONS = {
    "budget_approve": (
        "Approve because {amount} fits within the remaining budget of {remaining}, "
        "leaving {difference} available."
    ),
    "budget_reject": (
        "Reject because {amount} exceeds the remaining budget of {remaining} by {difference}."
    ),
    "expense": (
        "Classify the {amount} charge from {vendor} as {bucket} because the vendor and "
        "purchase intent match that expense bucket for {team}."
    ),
    "fraud_review": (
        "Escalate for review because the transaction shows {score} material fraud signals "
        "across velocity, geolocation, device trust, or amount."
    ),
    "fraud_allow": (
        "Allow because only {score} material fraud signals are present and the transaction "
        "remains below the review threshold."
    ),
    "policy_vendor": "the vendor is not on the approved list",
    "policy_limit": "the amount exceeds the policy limit by {excess}",
    "policy_manager": "manager approval is missing for a high-value purchase",
    "policy_receipt": "the receipt is missing",
    "policy_reject": "Reject because {problems}.",
    "policy_approve": (
        "Approve because the vendor, limit, receipt, and approval requirements all satisfy policy."
    ),
    "tax_deductible": (
        "Treat the {expense_type} expense as deductible because business use is {percent}% "
        "and documentation is available."
    ),
    "tax_not_deductible": (
        "Do not treat the {expense_type} expense as deductible because business use is mixed, "
        "insufficient, or undocumented."
    ),
    "spend_alert": (
        "Raise an alert because forecast spend of {forecast} is {variance}% versus the budget "
        "of {budget}."
    ),
    "spend_quiet": (
        "No alert is required because forecast spend of {forecast} stays close to the budget "
        "of {budget}."
    ),
    "invest_buy": (
        "Recommend buy because growth, margins, leverage, cash generation, and valuation versus "
        "peers are all attractive."
    ),
    "invest_hold": (
        "Recommend hold because the business has mixed fundamentals and does not clear a "
        "high-conviction buy threshold."
    ),
    "invest_avoid": (
        "Avoid because growth, margins, leverage, or valuation are too weak for a favorable "
        "investment case."
    ),
    "loan_approve": (
        "Approve because debt service coverage, collateral support, and credit quality meet "
        "lending thresholds."
    ),
    "loan_reject": (
        "Reject because repayment coverage, credit history, or leverage falls outside acceptable "
        "lending policy."
    ),
    "loan_review": (
        "Send for review because the loan shows mixed underwriting signals and needs analyst "
        "judgment."
    ),
    "ratios_healthy": (
        "The ratios indicate strong liquidity, manageable leverage, adequate interest coverage, "
        "and healthy profitability."
    ),
    "ratios_distressed": (
        "The ratio profile indicates liquidity or leverage stress that merits caution."
    ),
    "batch_approve": (
        "Approve because the proposed batch total of {total} fits inside the remaining budget "
        "of {remaining}."
    ),
    "batch_reject": (
        "Reject because the transaction batch totals {total}, which exceeds the remaining budget "
        "of {remaining}."
    ),
    "anomaly_outlier": (
        "Flag as an outlier because the transaction is {z} standard deviations from the "
        "historical average and does not match a recurring pattern."
    ),
    "anomaly_normal": (
        "Treat as normal because the observed amount sits within an acceptable range of the "
        "baseline distribution at a z-score of {z}."
    ),
    "deal_accretive": (
        "The transaction looks accretive because expected synergies and EBITDA support outweigh "
        "financing drag without excessive dilution or leverage."
    ),
    "deal_dilutive": (
        "The transaction looks dilutive because financing burden, dilution, or post-close leverage "
        "overwhelms the operating benefits."
    ),
    "deal_review": (
        "The transaction needs review because the accretion case is borderline and depends on "
        "execution assumptions."
    ),
}

# The twelve categories in their round-robin order, with their instructions.
INSTRUCTIONS = {
    "budget_reasoning": "Evaluate the transaction against the remaining budget.",
    "expense_classification": "Classify the expense into the correct accounting category.",
    "fraud_detection": "Assess the transaction for fraud risk.",
    "policy_compliance": "Check whether the expense complies with company policy.",
    "tax_deduction_advice": "Give a preliminary tax deduction recommendation.",
    "spending_alerts": "Check whether the account needs a spending alert.",
    "investment_analysis": "Analyze whether the investment looks attractive.",
    "loan_evaluation": "Evaluate whether the company loan should be approved.",
    "financial_ratios": "Assess the company's financial ratio health.",
    "multi_transaction_budgeting": (
        "Decide whether the batch of transactions can be approved together."
    ),
    "anomaly_detection": "Determine whether the transaction is anomalous.",
    "corporate_finance_reasoning": "Assess whether the acquisition is financially attractive.",
}

# Vendors and the expense bucket each belongs to.
VENDOR_BUCKETS = (
    ("OpenAI API", "software_saas"),
    ("Slack Enterprise Grid", "software_saas"),
    ("AWS GPU reservation", "cloud_infrastructure"),
    ("Datadog annual contract", "monitoring"),
    ("Delta flight", "travel"),
    ("Hilton stay", "travel"),
    ("Google Ads", "marketing"),
    ("LinkedIn recruiting", "recruiting"),
    ("Payroll transfer", "payroll"),
    ("Office Depot", "office_supplies"),
)

# The words scenarios choose from.
DEPARTMENTS = ("finance", "engineering", "growth", "operations", "sales")
PURCHASES = (
    "AI SaaS subscription", "GPU training credits", "contractor invoice", "travel reimbursement",
    "security audit", "annual data vendor renewal",
)
INDUSTRIES = ("fintech", "enterprise software", "healthcare", "ecommerce", "logistics")
POLICY_EXPENSES = ("software", "travel", "consulting", "office supplies")
TAX_EXPENSES = (
    "home office desk", "client dinner", "business mileage", "developer laptop",
    "family vacation flight",
)
PERIODS = ("monthly", "quarterly")
COST_CENTERS = ("infrastructure", "sales", "g&a")
TRANSACTION_TYPES = ("software", "travel", "consulting", "marketing")
