"""Variable maps of the registered queries."""

from __future__ import annotations

from wavemeld.spec import Spec

# Orders and line items as two waves of one survey.
WAVES = Spec.from_dict({
    "status": {"colnames": ["O_OrderStatus"], "keywords": ["linestatus"], "type": "integer", "label": "Order status",
               "value": {1: "Open", 2: "Filled"}, "recode": {"O": 1, "F": 2, "P": 3}},
    "priority": {"colnames": ["O_OrderPriority"], "type": "integer", "label": "Priority",
                 "value": {1: "Urgent", 2: "High", 3: "Medium", 5: "Low"},
                 "recode": {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}, "missing": [5]},
    "line": {"colnames": ["L_LineNumbr"], "type": "integer", "label": "Line",
             "value": {i: f"Line {i}" for i in range(1, 6)}, "missing": ["NA", 7]},
    "amount": {"colnames": ["o_totalprice"], "keywords": ["extendedprice"], "type": "numeric", "label": "Amount"},
    "quantity": {"colnames": ["l_quantity"], "type": "integer", "label": "Quantity", "recode": {"18": 99},
                 "missing": [7]},
    "discount": {"colnames": ["l_discount"], "type": "logical", "label": "Has a discount"},
    "shipped": {"colnames": ["l_shipdate"], "type": "datestamp", "label": "Ship date"},
})

# String-coded and integer-coded columns that are labelled.
LABELLED = Spec.from_dict({
    "l_linenumber": {"type": "integer", "label": "Line number", "value": {i: f"Line {i}" for i in range(1, 6)}},
    "l_quantity": {"type": "integer", "label": "Quantity", "value": {i: f"{i} pieces" for i in range(1, 41)}},
    "l_tax": {"type": "double", "label": "Tax"},
})

CODES = Spec.from_dict({
    "event_type": {"type": "integer", "label": "Type of event",
                   "value": {1: "click", 2: "view", 3: "purchase"},
                   "recode": {"click": 1, "view": 2, "purchase": 3, "signup": 4}},
    "l_returnflag": {"type": "integer", "label": "Return flag", "value": {1: "Accepted", 2: "Returned"},
                     "recode": {"A": 1, "R": 2, "N": 3}},
    "o_orderstatus": {"type": "integer", "label": "Order status", "value": {1: "Open", 2: "Filled", 3: "Partly"},
                      "recode": {"O": 1, "F": 2, "P": 3}},
    "quality": {"type": "integer", "label": "Quality", "value": {0: "low", 1: "high"}},
    "toxic": {"type": "integer", "label": "Toxic", "value": {0: "no", 1: "yes"}},
})

# Words of a document as the column names of a file.
WORDS = Spec.from_dict({
    "article": {"colnames": ["The", "der", "les"], "keywords": ["the", "with", "from"]},
    "motion": {"colnames": ["tion", "ation_code"], "keywords": ["with", "this", "for"]},
    "state": {"colnames": ["was", "is it"], "keywords": ["this", "from", "and"]},
    "site": {"colnames": ["web_site", "source"], "keywords": ["http", "https", "www", "that"]},
    "contact": {"colnames": ["e-mail"], "keywords": ["mail", "com", "org", "NA"]},
    "rights": {"keywords": ["license", "copyright", "mit", "and"]},
})

# Order files with rows of another width than their header.
RAGGED = Spec.from_dict({
    "key": {"colnames": ["o_orderkey"], "type": "integer", "label": "Order"},
    "status": {"colnames": ["o_orderstatus"], "type": "character", "label": "Order status"},
    "priority": {"colnames": ["o_orderpriority"], "type": "character", "label": "Priority"},
})
