"""Small inputs with hand-derived results: gauges, pumps and the berths of a harbour."""

MESSAGE_SCHEMA = (
    "raw_value string, topic string, partition int, offset bigint, timestamp bigint, key string, "
    "headers map<string,string>"
)
MESSAGES = [
    ('{"station": "Brenn", "level": 412, "river": "Aul"}', "gauges", 2, 71, 1935468428000, "g-17", {"via": "radio"}),
    ('{"pump": "P9", "flow": 3.25, "open": false}', "pumps", 0, 72, 1935468429500, "p-9", {}),
]
MALFORMED = [
    ('{"station": "Brenn", "level": ', "gauges", 2, 73),
    ("-- line lost --", "pumps", 0, 74),
]

ARRIVALS_SCHEMA = (
    "keeper string, berths string, depth_m string, keeper_email string, hotline_tel string, moored string, seen_at string, "
    "remark string, grade string"
)
ARRIVALS = [
    (" Ilse Marn ", "12", "4.75", "ilse.marn@quay.example", "555 010 2234", "yes", "2031-05-02 06:07:08", "", "N/A"),
    ("Otto", "7.0", "0.5", "OTTO@Dock.Example", "+49 30 5550199", "no", "2031-05-03", " calm", "-"),
]
ARRIVALS_META = [("kafka", "harbour", 3, 71, 1935468428000, None), ("kafka", "harbour", 1, 72, 1935554828000, None)]

BERTH_SCHEMA = (
    "_id string, berth_name string, slots string, office_email string, office_tel string, lit string, fee_total string, "
    "surveyed_on string, memo string, state string"
)
BERTH = ("berth-0042", "North Mole ", "31", "Mole@port.example", "(202) 555-0143", "1", "88.25", "2030-11-12 13:14:15", "", "tbd")
BERTH_META = ("mongodb", None, None, None, None, "berth-0042")
META_SCHEMA = "struct<source_type:string,topic:string,partition:int,offset:bigint,timestamp:bigint,document_id:string>"

CLEAN = {"validate_emails": True, "clean_phone_numbers": True, "null_values": ["", "-", "N/A", "tbd"]}
MAPPINGS = {
    "kafka": {
        "warden": ["keeper"],
        "places": ["berths"],
        "depth": ["depth_m"],
        "write_to": ["keeper_email"],
        "ring": ["hotline_tel"],
        "tied_up": ["moored"],
        "noted_at": ["seen_at"],
        "grade": ["grade"],
    },
    "mongodb": {
        "warden": ["berth_name"],
        "places": ["slots"],
        "write_to": ["office_email"],
        "ring": ["office_tel"],
        "lit": ["lit"],
        "fee": ["fee_total"],
        "noted_at": ["surveyed_on"],
    },
}
CONVERSIONS = {
    "berths": "int",
    "depth_m": "float",
    "moored": "bool",
    "seen_at": "datetime",
    "lit": "bool",
    "fee": "float",
    "surveyed_on": "datetime",
}


def records(spark, documents=True):
    """The arrivals and the berth as one frame, absent fields NULL."""
    n, m = len(ARRIVALS[0]), len(BERTH)
    rows = [(*values, *[None] * m, meta) for values, meta in zip(ARRIVALS, ARRIVALS_META)]
    if documents:
        rows.append((*[None] * n, *BERTH, BERTH_META))
    return spark.createDataFrame(rows, f"{ARRIVALS_SCHEMA}, {BERTH_SCHEMA}, _meta {META_SCHEMA}")
