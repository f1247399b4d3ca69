"""Texts, word lists, lookup tables and formats that results must match exactly.

Nothing in this module is logic. The values stay plain and in their natural order so that they
can be compared by eye with the data sets and prompts they describe.
"""

# --- fixed values: prompt texts ---------------------------------------------------------------
TRAIN_SYSTEM_PROMPT = (
    "You are a financial crime intelligence expert with deep expertise in:\n"
    "- Transaction fraud detection (credit card, mobile payments, e-commerce)\n"
    "- Anti-money laundering (AML) and financial crime typology analysis\n"
    "- Suspicious Activity Report (SAR) generation\n"
    "- Regulatory compliance (FATF, BSA, AML/CFT frameworks)\n"
    "\n"
    "When presented with a financial transaction or account activity profile,\n"
    "you analyze the features and provide a structured risk assessment.\n"
    "Always respond in valid JSON format as specified."
)

INFER_SYSTEM_PROMPT = (
    "You are a financial crime intelligence expert. "
    "Analyze the transaction and respond ONLY in valid JSON format with keys: "
    "verdict (FRAUD|LEGITIMATE), risk_score (1-5), risk_level (LOW|MEDIUM|HIGH), "
    "fraud_type, aml_typology, risk_indicators (list), recommended_action, confidence."
)

TRAIN_USER_OPENING = (
    "Analyze the following financial transaction for potential fraud or money laundering activity."
)
TRAIN_USER_CLOSING = (
    "Provide a comprehensive financial crime risk assessment in the JSON format specified."
)
INFER_USER_OPENING = "Analyze the following transaction for potential fraud or AML risk."
INFER_USER_CLOSING = "Provide a structured JSON risk assessment."
DEFAULT_CONTEXT = "Financial transaction"

# --- fixed values: data set names and contexts ------------------------------------------------
DATASETS = ["ccf", "ieee_cis", "paysim", "ibm_aml", "elliptic", "banksim"]

DATASET_CONTEXT = {
    "ccf": "European cardholder credit card transaction (Sept 2013)",
    "ieee_cis": "E-commerce transaction with identity signals (Vesta Corp dataset)",
    "paysim": "Mobile money transfer transaction (West African mobile service)",
    "ibm_aml": "Inter-bank wire transfer (IBM AML synthetic financial network)",
    "elliptic": "Bitcoin blockchain transaction (Elliptic financial forensics dataset)",
    "banksim": "Retail bank transaction (Spanish bank customer activity)",
}

# --- fixed values: answer vocabulary ----------------------------------------------------------
FRAUD_TYPES = {
    "ccf": ["card-not-present fraud", "account takeover", "stolen card"],
    "ieee_cis": ["identity theft", "device spoofing", "card testing", "friendly fraud",
                 "synthetic identity"],
    "paysim": ["cash-out fraud", "transfer layering", "mule account activity",
               "rapid fund movement"],
    "ibm_aml": ["layering", "fan-out structuring", "scatter-gather pattern",
                "round-trip transactions", "shell account activity"],
    "elliptic": ["ransomware payment", "darknet marketplace", "scam", "Ponzi scheme",
                 "terrorist financing", "malware"],
    "banksim": ["merchant fraud", "account takeover", "unusual purchase pattern"],
}
DEFAULT_FRAUD_TYPES = ["unspecified fraud"]

AML_TYPOLOGIES = {
    "ibm_aml": ["fan-in", "fan-out", "bipartite", "cycle", "scatter-gather", "gather-scatter",
                "random", "stack"],
}

HIGH_AMOUNT_INDICATOR = "Unusually high transaction amount compared to account profile"
BALANCE_INDICATOR = "Significant balance change inconsistent with normal activity"

FRAUD_INDICATORS = [
    "Transaction pattern deviates from established customer baseline",
    "Velocity anomaly: high frequency of transactions in short window",
    "Geographic/IP mismatch with cardholder profile",
    "Transaction amount near reporting threshold (structuring indicator)",
    "High-risk merchant category code",
    "New account with immediate high-value activity",
    "Destination account has no prior transaction history",
    "Funds rapidly moved onward within minutes of receipt",
]
LEGIT_INDICATORS = [
    "Transaction within normal amount range for this customer segment",
    "Consistent with established spending patterns",
    "Merchant category aligns with customer profile",
    "No velocity anomalies detected",
    "Device and location consistent with prior activity",
]

RECOMMENDED_ACTIONS = {
    5: "BLOCK and escalate to fraud analyst. File SAR if laundering confirmed.",
    4: "HOLD for manual review. Request additional verification.",
    3: "MONITOR. Flag for enhanced due diligence on next transaction.",
}
DEFAULT_ACTION = "APPROVE. No suspicious indicators detected."

PARSE_ERROR_NOTE = "Model output was not valid JSON"

# --- fixed values: chat template marks --------------------------------------------------------
HEADER_START = "<|start_header_id|>"
HEADER_END = "<|end_header_id|>"
TURN_END = "<|eot_id|>"

# --- fixed values: category codes -------------------------------------------------------------
AGE_CODES = {"U": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5, "6": 6, "O": 7}
CLASS_CODES = {"1": 1, "2": 0}

# --- fixed values: expected raw files ---------------------------------------------------------
EXPECTED_FILES = {
    "ccf": ["creditcard.csv"],
    "ieee_cis": ["train_transaction.csv", "train_identity.csv"],
    "paysim": ["PS_20174392719_1491204439457_log.csv"],
    "ibm_aml": ["HI-Small_Trans.csv"],
    "elliptic": ["elliptic_txs_features.csv", "elliptic_txs_classes.csv",
                 "elliptic_txs_edgelist.csv"],
    "banksim": ["bs140513_032310.csv"],
}

# --- fixed values: the six data set records ---------------------------------------------------
REGISTRY_FIELDS = [
    "name", "alias", "description", "source_url", "download_command", "size_rows", "fraud_ratio",
    "features", "label_column", "use_case", "preprocessing_notes", "license",
]

REGISTRY = [
    {
        "name": "Credit Card Fraud Detection (ULB)",
        "alias": "ccf",
        "description": "Real transactions made by European cardholders in September 2013. "
                       "28 PCA-anonymized features (V1-V28), plus 'Time' and 'Amount'. "
                       "Highly imbalanced: only 0.172% are fraudulent.",
        "source_url": "https://www.kaggle.com/datasets/mlg-ulb/creditcardfraud",
        "download_command": "kaggle datasets download -d mlg-ulb/creditcardfraud",
        "size_rows": "284,807",
        "fraud_ratio": "0.172% (492 fraud / 284,315 legit)",
        "features": "30 (Time, V1-V28, Amount) + Class",
        "label_column": "Class",
        "use_case": ["credit card fraud", "anomaly detection", "binary classification"],
        "preprocessing_notes": "StandardScaler on Amount and Time. "
                               "Use SMOTE / class_weight='balanced'. "
                               "Features already PCA-transformed — no need for further encoding.",
        "license": "Open Database License (ODbL)",
    },
    {
        "name": "IEEE-CIS Fraud Detection",
        "alias": "ieee_cis",
        "description": "Real-world e-commerce transaction data from Vesta Corporation. "
                       "590K+ transactions with 400+ features including device, email domain, "
                       "card details, and anonymized Vesta-engineered features.",
        "source_url": "https://www.kaggle.com/competitions/ieee-fraud-detection",
        "download_command": "kaggle competitions download -c ieee-fraud-detection",
        "size_rows": "590,540 (train)",
        "fraud_ratio": "3.5%",
        "features": "400+ (transaction + identity tables)",
        "label_column": "isFraud",
        "use_case": ["e-commerce fraud", "identity fraud", "multi-table joins"],
        "preprocessing_notes": "Merge transaction_train.csv with identity_train.csv on "
                               "TransactionID. Drop columns with >50% nulls. Impute with "
                               "median/mode. Label-encode high-cardinality categoricals "
                               "(card1-6, addr1-2, etc.).",
        "license": "Competition license (research/academic use)",
    },
    {
        "name": "PaySim Synthetic Financial Dataset",
        "alias": "paysim",
        "description": "Synthetic mobile money transaction dataset generated by PaySim simulator. "
                       "Based on real transaction logs from an African mobile money service. "
                       "6.3M transactions; 5 types: CASH-IN, CASH-OUT, DEBIT, PAYMENT, TRANSFER.",
        "source_url": "https://www.kaggle.com/datasets/ealaxi/paysim1",
        "download_command": "kaggle datasets download -d ealaxi/paysim1",
        "size_rows": "6,362,620",
        "fraud_ratio": "0.13% (8,213 fraud cases)",
        "features": "11 (step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, "
                    "nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud)",
        "label_column": "isFraud",
        "use_case": ["mobile payment fraud", "AML", "transaction monitoring"],
        "preprocessing_notes": "One-hot encode 'type' column. Drop 'nameOrig' and 'nameDest' "
                               "(high cardinality). Feature engineer: balance_diff_orig = "
                               "newbalanceOrig - oldbalanceOrg. Caution: "
                               "oldbalanceOrg/newbalanceDest can cause data leakage.",
        "license": "CC BY-SA 4.0",
    },
    {
        "name": "IBM AML Synthetic Dataset (HI-Small)",
        "alias": "ibm_aml",
        "description": "Synthetic AML transaction graph generated by IBM's multi-agent simulator. "
                       "Models 8 money laundering typologies: fan-in, fan-out, bipartite, stack, "
                       "random, cycle, scatter-gather, gather-scatter. "
                       "HI-Small subset: ~5M transactions, high-illicit ratio variant.",
        "source_url": "https://github.com/IBM/AMLSim",
        "download_command": "git clone https://github.com/IBM/AMLSim && # OR download from: "
                            "# https://www.kaggle.com/datasets/ealtman2019/"
                            "ibm-transactions-for-anti-money-laundering-aml",
        "size_rows": "~5M (HI-Small variant)",
        "fraud_ratio": "~2-10% depending on variant (HI = High Illicit)",
        "features": "EdgeID, from_id, to_id, amount, currency, transaction_type, timestamp, "
                    "is_laundering, laundering_type",
        "label_column": "is_laundering",
        "use_case": ["AML", "money laundering detection", "graph-based fraud",
                     "typology classification"],
        "preprocessing_notes": "Parse timestamps to extract hour/day/week features. "
                               "Aggregate per-account: total_sent, total_received, "
                               "num_transactions_24h. "
                               "One-hot encode transaction_type and currency. "
                               "For LLM fine-tuning: include laundering_type as part of the "
                               "label context.",
        "license": "Apache 2.0",
    },
    {
        "name": "Elliptic Bitcoin Dataset",
        "alias": "elliptic",
        "description": "Real Bitcoin blockchain transaction graph from Elliptic. "
                       "203K transaction nodes, 234K edges (fund flows). "
                       "Labels: illicit (scams, malware, terrorism, ransomware) vs licit. "
                       "166 anonymized features per node.",
        "source_url": "https://www.kaggle.com/datasets/ellipticco/elliptic-data-set",
        "download_command": "kaggle datasets download -d ellipticco/elliptic-data-set",
        "size_rows": "203,769 nodes / 234,355 edges",
        "fraud_ratio": "2% illicit (4,545), 21% licit (42,019), 77% unknown",
        "features": "166 per node (94 local + 72 aggregated neighbourhood features)",
        "label_column": "class (1=illicit, 2=licit)",
        "use_case": ["crypto AML", "blockchain forensics", "financial crime detection"],
        "preprocessing_notes": "Merge txs_features.csv + txs_classes.csv on txId. "
                               "Filter out 'unknown' class-3 nodes for supervised learning. "
                               "Remap labels: 1 (illicit) → fraud, 2 (licit) → legit. "
                               "Normalize all 166 features with StandardScaler.",
        "license": "CC BY 4.0",
    },
    {
        "name": "BankSim Synthetic Bank Transactions",
        "alias": "banksim",
        "description": "Synthetic bank transaction dataset generated with BankSim tool "
                       "based on a real Spanish bank. Covers ~6 months of activity.",
        "source_url": "https://www.kaggle.com/datasets/ntnu-testimon/banksim1",
        "download_command": "kaggle datasets download -d ntnu-testimon/banksim1",
        "size_rows": "~594,643",
        "fraud_ratio": "~1.2%",
        "features": "step, customer, age, gender, merchant, category, amount, fraud",
        "label_column": "fraud",
        "use_case": ["retail banking fraud", "merchant fraud", "customer profiling"],
        "preprocessing_notes": "Label-encode merchant and category. "
                               "Bin age into brackets. "
                               "Compute per-customer spending profiles as context features.",
        "license": "CC BY-SA 4.0",
    },
]

# Columns of two recipes, and texts and forms that raw files use for missing values and times.
AML_ENCODED = ["payment_currency", "receiving_currency", "payment_format", "account", "account.1"]
PAYSIM_DROPPED = ["nameOrig", "nameDest", "isFlaggedFraud", "oldbalanceOrg", "newbalanceOrig",
                  "oldbalanceDest", "newbalanceDest"]
MISSING_TEXTS = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None"]
TIME_FORMATS = ["yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd"]
