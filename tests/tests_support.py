import json

SF001 = "/root/testdata/sf0.001"


def doc(guid, day, amount, version):
    return json.dumps({"guid": guid, "businessDate": day, "openedDate": "2026-06-26T17:00:00.000+0000", "version": version,
                       "checks": [{"guid": "c", "amount": amount, "totalAmount": amount, "taxAmount": 0.0}]})
