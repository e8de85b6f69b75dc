"""The seed rows of the dimensions and the bad rows that the seeds plant."""

# Fixed values (region_code, region_name).
REGIONS = [
    ("NE", "Northeast"),
    ("SE", "Southeast"),
    ("MW", "Midwest"),
    ("SW", "Southwest"),
    ("W", "West"),
    ("Central", "Central"),
]

# Fixed values (channel_code, channel_name).
CHANNELS = [
    ("ONLINE", "Online Store"),
    ("RETAIL", "Retail Stores"),
    ("DIST", "Distributor Network"),
    ("DIRECT", "Direct Sales"),
]

# Fixed values (rule_name, rule_type, priority, start_date, end_date, is_active).
PRICING_RULES = [
    ("Volume Discount Tier 1", "VOLUME", 1, "2024-01-01", "2025-12-31", True),
    ("Competitive Match Policy", "COMPETITIVE", 2, "2024-06-01", "2025-06-30", True),
    ("Seasonal Promotion Q1", "SEASONAL", 3, "2025-01-01", "2025-03-31", True),
    ("Channel Pricing Online", "CHANNEL", 2, "2024-01-01", None, True),
    ("Emergency Pricing Override", "OVERRIDE", 1, "2024-01-01", "2025-12-31", True),
    ("End of Life Discount", "EOL", 4, "2024-09-01", "2024-12-31", False),
    ("New Product Launch", "LAUNCH", 2, "2025-01-15", "2025-04-15", True),
    ("Regional Adjustment NE", "REGIONAL", 5, "2024-03-01", "2025-03-01", True),
    ("Bulk Order Discount", "VOLUME", 3, "2024-01-01", None, True),
    ("Contract Pricing Tier", "CONTRACT", 1, "2024-01-01", "2025-12-31", True),
]

# Fixed values (sku, product_name, category, brand); all are active.
PRODUCTS = [
    ("SKU-10001", "Sterile Gloves Premium", "Medical", "MedTech"),
    ("SKU-10002", "Surgical Scalpel Set", "Surgical", "SurgiPro"),
    ("SKU-10003", "Antibiotic Ointment", "Pharma", "PharmCore"),
    ("SKU-10004", "Digital Thermometer", "Consumer", "HealthHome"),
    ("SKU-10005", "X-Ray Machine Mobile", "Equipment", "MedEquip"),
    ("SKU-10006", "Disposable Syringes 10ml", "Medical", "MedTech"),
    ("SKU-10007", "Surgical Mask N95", "Medical", "MedTech"),
    ("SKU-10008", "Suture Kit Professional", "Surgical", "SurgiPro"),
    ("SKU-10009", "Pain Relief Capsules", "Pharma", "PharmCore"),
    ("SKU-10010", "Blood Pressure Monitor", "Consumer", "HealthHome"),
    ("SKU-10011", "Ultrasound Scanner", "Equipment", "MedEquip"),
    ("SKU-10012", "Bandage Roll 4in", "Medical", "MedTech"),
    ("SKU-10013", "Surgical Forceps", "Surgical", "SurgiPro"),
    ("SKU-10014", "Antihistamine Tablets", "Pharma", "PharmCore"),
    ("SKU-10015", "First Aid Kit Deluxe", "Consumer", "HealthHome"),
    ("SKU-10016", "ECG Machine Portable", "Equipment", "MedEquip"),
    ("SKU-10017", "IV Catheter 18G", "Medical", "MedTech"),
    ("SKU-10018", "Surgical Scissors", "Surgical", "SurgiPro"),
    ("SKU-10019", "Cough Syrup", "Pharma", "PharmCore"),
    ("SKU-10020", "Pulse Oximeter", "Consumer", "HealthHome"),
    ("SKU-10021", "Defibrillator AED", "Equipment", "MedEquip"),
    ("SKU-10022", "Gauze Pads 4x4", "Medical", "MedTech"),
    ("SKU-10023", "Surgical Retractor", "Surgical", "SurgiPro"),
    ("SKU-10024", "Antacid Tablets", "Pharma", "PharmCore"),
    ("SKU-10025", "Neck Brace Adjustable", "Consumer", "HealthHome"),
    ("SKU-10026", "Ventilator ICU", "Equipment", "MedEquip"),
    ("SKU-10027", "Alcohol Swabs 100ct", "Medical", "MedTech"),
    ("SKU-10028", "Surgical Clamp", "Surgical", "SurgiPro"),
    ("SKU-10029", "Cold & Flu Medicine", "Pharma", "PharmCore"),
    ("SKU-10030", "Knee Brace Support", "Consumer", "HealthHome"),
    ("SKU-10031", "MRI Machine 3T", "Equipment", "MedEquip"),
    ("SKU-10032", "Wound Dressing Pack", "Medical", "MedTech"),
    ("SKU-10033", "Surgical Needle Holder", "Surgical", "SurgiPro"),
    ("SKU-10034", "Vitamin D Supplements", "Pharma", "PharmCore"),
    ("SKU-10035", "Ankle Support Wrap", "Consumer", "HealthHome"),
    ("SKU-10036", "CT Scanner 64-Slice", "Equipment", "MedEquip"),
    ("SKU-10037", "Adhesive Tape Medical", "Medical", "MedTech"),
    ("SKU-10038", "Surgical Blade #11", "Surgical", "SurgiPro"),
    ("SKU-10039", "Multivitamin Capsules", "Pharma", "PharmCore"),
    ("SKU-10040", "Wrist Support Brace", "Consumer", "HealthHome"),
    ("SKU-10041", "Infusion Pump", "Equipment", "MedEquip"),
    ("SKU-10042", "Cotton Swabs Sterile", "Medical", "MedTech"),
    ("SKU-10043", "Surgical Hemostat", "Surgical", "SurgiPro"),
    ("SKU-10044", "Calcium Supplements", "Pharma", "PharmCore"),
    ("SKU-10045", "Back Support Belt", "Consumer", "HealthHome"),
    ("SKU-10046", "Patient Monitor", "Equipment", "MedEquip"),
    ("SKU-10047", "Disposable Gloves Latex", "Medical", "MedTech"),
    ("SKU-10048", "Surgical Probe", "Surgical", "SurgiPro"),
    ("SKU-10049", "Iron Supplements", "Pharma", "PharmCore"),
    ("SKU-10050", "Compression Stockings", "Consumer", "HealthHome"),
    ("SKU-10051", "Autoclave Sterilizer", "Equipment", "MedEquip"),
    ("SKU-10052", "Antiseptic Solution", "Medical", "MedTech"),
    ("SKU-10053", "Surgical Sponge", "Surgical", "SurgiPro"),
    ("SKU-10054", "Probiotic Capsules", "Pharma", "PharmCore"),
    ("SKU-10055", "Elbow Support Brace", "Consumer", "HealthHome"),
]

# Staged price rows with a bad sku (sku, region_code, channel_code, price).
BAD_SKU_PRICES = [
    (None, "NE", "ONLINE", "99.99"),
    (None, "SE", "RETAIL", "149.50"),
    (None, "MW", "DIST", "199.00"),
    (None, "SW", "DIRECT", "249.75"),
    (None, "W", "ONLINE", "299.99"),
    (None, "Central", "RETAIL", "89.50"),
    ("", "NE", "RETAIL", "179.25"),
    ("", "SE", "DIST", "219.00"),
    ("", "MW", "DIRECT", "159.99"),
    ("", "SW", "ONLINE", "269.50"),
    ("", "W", "RETAIL", "189.75"),
    ("", "Central", "DIST", "209.25"),
    ("INVALID-SKU-99999", "NE", "RETAIL", "149.50"),
    ("SKU-XXXXX", "SW", "DIRECT", "249.75"),
    ("SKU-99999", "W", "ONLINE", "299.99"),
    ("BAD-SKU-001", "NE", "DIST", "179.25"),
    ("SKU-NULL", "MW", "ONLINE", "159.99"),
    ("INVALID", "SW", "RETAIL", "269.50"),
]

# Overlapping discounts on one key (type, value, first day, last day), days from day 0.
OVERLAP_KEY = ("SKU-10010", "NE", "ONLINE")
OVERLAPPING_DISCOUNTS = [
    ("PERCENT", "15.0", 0, 10),
    ("PERCENT", "20.0", 5, 15),
    ("FLAT", "50.0", 8, 18),
    ("PERCENT", "25.0", 2, 12),
    ("FLAT", "75.0", 1, 14),
]
