"""Paths and role schemas that several test modules share (a plain module: no test imports a conftest)."""

import datetime as dt

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

ROLE_SCHEMAS = {
    "contract": "codigo long, idcontrato long, status int, assinatura date, cancelamento date, vencimento date",
    "item": "id_contrato long, item long, quantidade decimal(10,0), valor decimal(14,4)",
    "task": "cliente long, nros long, nros_sub int, data_cad date, data_exe date, categoria long, subcategoria long, "
    "prioridade int, para1 long, stos string, cod_ps int",
    "task_history": "nros long, datafos date",
    "user": "cod_usu long, grupo_trabalho int",
    "category": "st long, dst string",
    "status": "cod string, sto string, descr string",
    "item_dict": "codigo long, grupo_produto string",
    "registry": "cod_cad long, nomecli string, empresa string",
    "product": "cod_ps int",
}


def d(s):
    return None if s is None else dt.date.fromisoformat(s)
