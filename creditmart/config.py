"""Fixed values of the mart: column types, accepted ranges, categories and names.

Everything here is plain configuration; the operators take the same values as
arguments, so a caller can pass other ones.
"""

from __future__ import annotations

KEYS = ["Customer_ID", "snapshot_date"]

# Column types of the loan snapshots.
LOAN_COLUMNS = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

# Column types of the customer financials.
FINANCIAL_COLUMNS = {
    "Customer_ID": "string",
    "Annual_Income": "double",
    "Monthly_Inhand_Salary": "double",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "double",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "double",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "string",
    "Outstanding_Debt": "double",
    "Credit_Utilization_Ratio": "double",
    "Credit_History_Age": "string",
    "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "double",
    "Amount_invested_monthly": "double",
    "Payment_Behaviour": "string",
    "Monthly_Balance": "double",
    "snapshot_date": "date",
}

# Personal columns that never leave the raw layer.
PII_COLUMNS = ["Name", "SSN"]

# Accepted closed ranges.
AGE_RANGE = (1, 100)
VALUE_RANGES = {
    "Interest_Rate": (0, 34),
    "Num_Bank_Accounts": (0, 11),
    "Num_Credit_Card": (0, 11),
    "Num_Credit_Inquiries": (0, 17),
    "Num_of_Delayed_Payment": (0, 28),
}
# Accepted closed ranges of column / Monthly_Inhand_Salary, in this order.
SALARY_RATIO_RANGES = {
    "Total_EMI_per_month": (0, 1),
    "Annual_Income": (0, 30),
}

# Columns that cannot be negative, and placeholders standing for "unknown".
NONNEGATIVE_COLUMNS = ["Monthly_Inhand_Salary", "Outstanding_Debt", "Amount_invested_monthly"]
INVESTED_PLACEHOLDER = 10000
BALANCE_FLOOR = -1e9

# Accepted categories.
CREDIT_MIXES = ["Standard", "Good", "Bad"]
MINIMUM_PAYMENTS = ["Yes", "No"]
PAYMENT_BEHAVIOUR_PATTERN = r"^(High|Low)_spent_(Small|Medium|Large)_value_payments$"
CREDIT_HISTORY_PATTERN = r"^\d+ Years? and \d+ Months?$"

# Default loan types; the backfill learns the list from the cleaned data.
# Output columns that one vocabulary or all categories together may become.
MAX_COLUMNS = 10_000

LOAN_TYPES = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Debt Consolidation Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Not Specified",
    "Payday Loan",
    "Personal Loan",
    "Student Loan",
]

# Gold feature settings.
LOG_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
UNKNOWN_CATEGORY = "Unknown"
CATEGORY_COLUMNS = ["Credit_Mix", "Payment_of_Min_Amount", "Spending_Behaviour", "Payments_Size"]

# Columns of a labelled loan that are no predictors.
METADATA_COLUMNS = [
    "loan_id",
    "Customer_ID",
    "loan_start_date",
    "feature_snapshot_date",
    "label_snapshot_date",
    "label_def",
    "label",
]
# Predictors whose missing values take the mean; the others take the median.
MEAN_FILL_COLUMNS = [
    "Age",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
]
