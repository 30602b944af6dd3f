"""Avro record schemas used as generator inputs (fixture shapes).

Fixed values: the eight input schemas of the generator round trip, as literals.
"""

AVRO_SCHEMAS = {'complex-union-records-fixed': {'type': 'record',
                                 'name': 'ComplexUnion',
                                 'fields': [{'name': 'complex_union',
                                             'type': ['null',
                                                      {'type': 'record',
                                                       'name': 'RecordA',
                                                       'fields': [{'name': 'field_a', 'type': 'string'}]},
                                                      {'type': 'record',
                                                       'name': 'RecordB',
                                                       'fields': [{'name': 'field_b', 'type': 'int'}]},
                                                      {'type': 'fixed', 'name': 'FixedBytes', 'size': 8}]}]},
 'deeply-nested-map-array': {'type': 'record',
                             'name': 'NestedMapArray',
                             'fields': [{'name': 'nested_map',
                                         'type': {'type': 'map',
                                                  'values': {'type': 'array',
                                                             'items': {'type': 'map',
                                                                       'values': {'type': 'array',
                                                                                  'items': 'string'}}}}}]},
 'fake-heavily-nested': {'type': 'record',
                         'name': 'example',
                         'fields': [{'name': 'field1',
                                     'type': {'type': 'array',
                                              'items': {'type': 'record',
                                                        'name': 'subrecord1',
                                                        'fields': [{'name': 'subfield1', 'type': 'int'},
                                                                   {'name': 'subfield2',
                                                                    'type': {'type': 'array',
                                                                             'items': {'type': 'record',
                                                                                       'name': 'subrecord2',
                                                                                       'fields': [{'name': 'subfield3',
                                                                                                   'type': 'string'},
                                                                                                  {'name': 'subfield4',
                                                                                                   'type': 'boolean'}]}}}]}}},
                                    {'name': 'field2',
                                     'type': {'type': 'map',
                                              'values': {'type': 'array',
                                                         'items': {'type': 'record',
                                                                   'name': 'subrecord3',
                                                                   'fields': [{'name': 'subfield5',
                                                                               'type': 'int'},
                                                                              {'name': 'subfield6',
                                                                               'type': {'type': 'array',
                                                                                        'items': {'type': 'record',
                                                                                                  'name': 'subrecord4',
                                                                                                  'fields': [{'name': 'subfield7',
                                                                                                              'type': 'string'},
                                                                                                             {'name': 'subfield8',
                                                                                                              'type': 'int'}]}}}]}}}}]},
 'fake-namespace-schema': {'namespace': 'com.example',
                           'type': 'record',
                           'name': 'Person',
                           'fields': [{'name': 'addresses',
                                       'type': {'type': 'array',
                                                'items': {'type': 'record',
                                                          'name': 'Address',
                                                          'namespace': 'com.example.person',
                                                          'fields': [{'name': 'street', 'type': 'string'},
                                                                     {'name': 'city', 'type': 'string'},
                                                                     {'name': 'state', 'type': 'string'},
                                                                     {'name': 'zipCode',
                                                                      'type': 'string'}]}}}]},
 'fake-nested-unions': {'type': 'record',
                        'name': 'example',
                        'fields': [{'name': '1union_null_int', 'type': ['null', 'int']},
                                   {'name': '2union_null_bool', 'type': ['null', 'boolean']},
                                   {'name': '3union_null_float_double', 'type': ['null', 'float', 'double']},
                                   {'name': '4union_null__record_of_str_int',
                                    'type': ['null',
                                             {'type': 'record',
                                              'name': 'subrecord1',
                                              'fields': [{'name': 'subfield1', 'type': 'string'},
                                                         {'name': 'subfield2', 'type': 'int'}]}]},
                                   {'name': '5union_null__record_of_str_bool',
                                    'type': ['null',
                                             {'type': 'record',
                                              'name': 'subrecord2',
                                              'fields': [{'name': 'subfield3', 'type': 'boolean'},
                                                         {'name': 'subfield4', 'type': 'string'}]}]},
                                   {'name': '6union_null__array_of_record_of_double_str',
                                    'type': ['null',
                                             {'type': 'array',
                                              'items': {'type': 'record',
                                                        'name': 'subrecord3',
                                                        'fields': [{'name': 'subfield5', 'type': 'double'},
                                                                   {'name': 'subfield6',
                                                                    'type': 'string'}]}}]},
                                   {'name': '7union_null__map_of_record_of_int_bool',
                                    'type': ['null',
                                             {'type': 'map',
                                              'values': {'type': 'record',
                                                         'name': 'subrecord4',
                                                         'fields': [{'name': 'subfield7', 'type': 'int'},
                                                                    {'name': 'subfield8',
                                                                     'type': 'boolean'}]}}]},
                                   {'name': '8union_null_enum',
                                    'type': ['null',
                                             {'type': 'enum',
                                              'name': 'status',
                                              'symbols': ['active', 'inactive', 'pending']}]},
                                   {'name': '9union_null__array_of_enum',
                                    'type': ['null',
                                             {'type': 'array',
                                              'items': {'type': 'enum',
                                                        'name': 'color',
                                                        'symbols': ['red', 'green', 'blue']}}]}]},
 'fixed-type': {'type': 'record',
                'name': 'FixedExample',
                'fields': [{'name': 'fixed_field',
                            'type': {'type': 'fixed', 'name': 'FixedBytes', 'size': 16}}]},
 'nullable-optional-with-defaults': {'type': 'record',
                                     'name': 'NullableOptional',
                                     'fields': [{'name': 'nullable_field', 'type': ['null', 'string']},
                                                {'name': 'optional_field',
                                                 'type': 'string',
                                                 'default': 'default_value'}]},
 'user_specific': {'namespace': 'confluent.io.examples.serialization.avro',
                   'name': 'User',
                   'type': 'record',
                   'fields': [{'name': 'name', 'type': 'string'},
                              {'name': 'favorite_number', 'type': 'long'},
                              {'name': 'favorite_color', 'type': 'string'}]}}

# The evolving pageviews record (v-latest) with its field defaults.
PAGEVIEWS_SCHEMA = {
    "namespace": "examples.pageviews", "name": "pageviews", "type": "record",
    "fields": [
        {"name": "viewtime", "type": "long"},
        {"name": "userid", "type": "string"},
        {"name": "pageid", "type": "string"},
        {"name": "address", "type": "string", "default": "null"},
        {"name": "added_column", "type": "string", "default": "null"},
        {"name": "added_column2", "type": "int", "default": 42},
    ],
}
