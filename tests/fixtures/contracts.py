"""Contract files and frames of the validation walkthrough, rebuilt as literals.

Each is a fixed value: saved contracts and golden outputs must match character by character.
"""

from tidewater.contracts import Check, Column, Contract

# Fixed values.
SCHEMA_JSON = {
    "schema_type": "dataframe", "version": "0.18.0",
    "columns": {
        "column1": {"title": None, "description": None, "dtype": "int64", "nullable": False,
                    "checks": {"greater_than_or_equal_to": 5.0, "less_than_or_equal_to": 20.0},
                    "unique": False, "coerce": False, "required": True, "regex": False},
        "column2": {"title": None, "description": None, "dtype": "object", "nullable": False, "checks": None,
                    "unique": False, "coerce": False, "required": True, "regex": False},
        "column3": {"title": None, "description": None, "dtype": "datetime64[ns]", "nullable": False,
                    "checks": {"greater_than_or_equal_to": "2010-01-01 00:00:00",
                               "less_than_or_equal_to": "2012-01-01 00:00:00"},
                    "unique": False, "coerce": False, "required": True, "regex": False},
    },
    "checks": None,
    "index": [{"title": None, "description": None, "dtype": "int64", "nullable": False,
               "checks": {"greater_than_or_equal_to": 0.0, "less_than_or_equal_to": 2.0},
               "name": None, "unique": False, "coerce": False}],
    "dtype": None, "coerce": True, "strict": False, "name": None, "ordered": False, "unique": None,
    "report_duplicates": "all", "unique_column_names": False, "add_missing_columns": False,
    "title": None, "description": None,
}

# Fixed values.
READER_YAML = """\
schema_type: dataframe
version: 0.18.0
columns:
  name:
    title: name
    description: 'Name of the person'
    dtype: string
    nullable: false
    checks:
      isin: ['Alice', 'Bob', 'Charlie', 'Dennis', 'Edith']
    unique: true
    coerce: false
    required: true
    regex: false
  age:
    title: age
    description: 'Age of the person'
    dtype: int16
    nullable: false
    checks:
      greater_than_or_equal_to: 18.0
    unique: false
    coerce: false
    required: true
    regex: false
  tenure:
    title: company_tenure
    description: 'Number of years the person has worked at the company'
    dtype: int16
    nullable: false
    checks: null
    unique: false
    coerce: false
    required: true
    regex: false
checks: null
index:
  - title: null
    description: null
    dtype: int64
    nullable: false
    checks:
      greater_than_or_equal_to: 0.0
    name: null
    unique: false
    coerce: false
dtype: null
coerce: true
strict: false
name: null
ordered: false
unique: null
report_duplicates: all
unique_column_names: false
add_missing_columns: false
title: null
description: null
"""

# The writer's contract is the reader's with one more column.
WRITER_YAML = """\
schema_type: dataframe
version: 0.18.0
columns:
  name:
    title: name
    description: 'Name of the person'
    dtype: string
    nullable: false
    checks:
      isin: ['Alice', 'Bob', 'Charlie', 'Dennis', 'Edith']
    unique: true
    coerce: false
    required: true
    regex: false
  age:
    title: age
    description: 'Age of the person'
    dtype: int16
    nullable: false
    checks:
      greater_than_or_equal_to: 18.0
    unique: false
    coerce: false
    required: true
    regex: false
  tenure:
    title: company_tenure
    description: 'Number of years the person has worked at the company'
    dtype: int16
    nullable: false
    checks: null
    unique: false
    coerce: false
    required: true
    regex: false
  tenure_percentage:
    title: tenure_percentage
    description: 'Percentage of the persons tenure at the company'
    dtype: float
    nullable: false
    checks:
      greater_than_or_equal_to: 0.0
      less_than_or_equal_to: 100.0
    unique: false
    coerce: false
    required: true
    regex: false
checks: null
index:
  - title: null
    description: null
    dtype: int64
    nullable: false
    checks:
      greater_than_or_equal_to: 0.0
    name: null
    unique: false
    coerce: false
dtype: null
coerce: true
strict: false
name: null
ordered: false
unique: null
report_duplicates: all
unique_column_names: false
add_missing_columns: false
title: null
description: null
"""

# Fixed values.
CITIES_YAML = """\
schema_type: dataframe
version: 0.18.0
columns:
  state:
    title: null
    description: null
    dtype: str
    nullable: false
    checks:
      isin:
      - FL
      - CA
    unique: false
    coerce: false
    required: true
    regex: false
  city:
    title: null
    description: null
    dtype: str
    nullable: false
    checks: null
    unique: true
    coerce: false
    required: true
    regex: false
  price:
    title: null
    description: null
    dtype: int64
    nullable: false
    checks:
      in_range:
        min_value: 5
        max_value: 20
        include_min: true
        include_max: true
    unique: false
    coerce: false
    required: true
    regex: false
checks: null
index: null
dtype: null
coerce: false
strict: false
name: Schema
ordered: false
unique: null
report_duplicates: all
unique_column_names: false
add_missing_columns: false
title: null
description: null
"""

# Fixed values.
EMPLOYEES = {"name": ["Alice", "Bob", "Charlie", "Dennis", "Edith"], "age": [25, 32, 29, 19, 22],
             "tenure": [3, 5, 2, 1, 4]}
# Golden output of the reader -> derive -> writer pipeline.
# Fixed values.
EMPLOYEE_TENURE_CSV = """name,age,tenure,tenure_percentage
Alice,25,3,12.0
Bob,32,5,15.625
Charlie,29,2,6.896551724137931
Dennis,19,1,5.263157894736842
Edith,22,4,18.181818181818183
"""

# Fixed values.
CITIES = {"state": ["FL", "FL", "FL", "CA", "CA", "CA"],
          "city": ["Orlando", "Miami", "Tampa", "San Francisco", "Los Angeles", "San Diego"],
          "price": [5, 12, 10, 16, 20, 18]}

# Fixed values.
VALID = {"column1": [1, 4, 0, 10, 9], "column2": [-1.3, -1.4, -2.9, -10.1, -20.4],
         "column3": ["value_1", "value_2", "value_3", "value_2", "value_1"]}
# Fixed values.
INVALID = {"column1": [1, 4, 0, 10, 9], "column2": [6.0, -1.4, -2.9, 10.1, -20.4],
           "column3": ["value_1", "value_2", "value_3", "value_2", "value_1"]}

# schema.json plus the column added by add_columns (as serialized after the addition).
COLUMN4 = {"title": None, "description": None, "dtype": "int64", "nullable": False,
           "checks": {"greater_than_or_equal_to": 0}, "unique": False, "coerce": False, "required": True,
           "regex": False}
SCHEMA_WITH_COLUMN4_JSON = dict(SCHEMA_JSON, columns=dict(SCHEMA_JSON["columns"], column4=COLUMN4))
