"""Declared schemas.

A declared schema is bound by position and saves the extra pass that inference needs.
"""

# Column order and types of the delimited inputs.
SCHEMAS = {
    "diamonds": "carat DOUBLE, cut STRING, color STRING, clarity STRING, depth DOUBLE, "
                "table DOUBLE, price INT, x DOUBLE, y DOUBLE, z DOUBLE",
    "accepted": "acc_term_id STRING, sid INT, first_name STRING, last_name STRING, major STRING",
    "alumni": "sid INT",
    "expelled": "sid INT",
    "unretained": "sid INT",
    "faculty": "fid INT, first_name STRING, last_name STRING, dept STRING",
    "course": "dept STRING, course STRING, prereq STRING, credits INT",
    "grades": "term_id STRING, course STRING, sid INT, fid INT, grade STRING",
    "stroke": "gender STRING, age DOUBLE, hypertension INT, heart_disease INT, "
              "ever_married STRING, work_type STRING, residence_type STRING, "
              "avg_glucose_level DOUBLE, bmi DOUBLE, smoking_status STRING, stroke INT",
    "forest_cover": "Elevation INT, Aspect INT, Slope INT, Horizontal_Distance_To_Hydrology INT, "
                    "Vertical_Distance_To_Hydrology INT, Horizontal_Distance_To_Roadways INT, "
                    "Hillshade_9am INT, Hillshade_Noon INT, Hillshade_3pm INT, "
                    "Horizontal_Distance_To_Fire_Points INT, Wilderness_Area STRING, "
                    "Soil_Type INT, Cover_Type INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "events": "event_id BIGINT, event_type STRING, user_id BIGINT, value DOUBLE",
}

# Field separators of the delimited inputs.
SEPARATORS = {
    "diamonds": "\t", "accepted": ",", "alumni": "\t", "expelled": "\t", "unretained": "\t",
    "faculty": ",", "course": ",", "grades": ",", "stroke": ",", "forest_cover": "\t",
    "part": "\t", "events": ",",
}


def column_names(name: str) -> list[str]:
    """Column names of a registered schema, without a session."""
    return [column.split()[0] for column in SCHEMAS[name].split(",")]
