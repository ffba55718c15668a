"""Student exam: course file (arq1), performance file (arq3) and questionnaire files."""

from __future__ import annotations

from aferir.schemas.layout import layout

PRESENT = 555

# Course file.
COURSE_FILE = layout(
    """
    ano int = NU_ANO
    co_curso bigint = CO_CURSO
    co_ies bigint = CO_IES
    tp_categoria_adm int = CO_CATEGAD
    tp_org_academica int = CO_ORGACAD
    co_grupo int = CO_GRUPO
    tp_modalidade int = CO_MODALIDADE
    co_municipio bigint = CO_MUNIC_CURSO
    co_uf int = CO_UF_CURSO
    co_regiao int = CO_REGIAO_CURSO; CO_REGIÃO_CURSO
    """
)

# Performance file. Answer vectors hold one character per question and stay text.
STUDENT_FILE = layout(
    """
    ano int = NU_ANO
    co_curso bigint = CO_CURSO
    tp_pres int = TP_PRES
    tp_pr_ger int = TP_PR_GER
    tp_pr_ob_fg int = TP_PR_OB_FG
    tp_pr_di_fg int = TP_PR_DI_FG
    tp_pr_ob_ce int = TP_PR_OB_CE
    tp_pr_di_ce int = TP_PR_DI_CE
    nu_item_ofg int = NU_ITEM_OFG
    nu_item_ofg_z int = NU_ITEM_OFG_Z
    nu_item_ofg_x int = NU_ITEM_OFG_X
    nu_item_ofg_n int = NU_ITEM_OFG_N
    nu_item_oce int = NU_ITEM_OCE
    nu_item_oce_z int = NU_ITEM_OCE_Z
    nu_item_oce_x int = NU_ITEM_OCE_X
    nu_item_oce_n int = NU_ITEM_OCE_N
    vt_gab_ofg = DS_VT_GAB_OFG_FIN
    vt_gab_oce = DS_VT_GAB_OCE_FIN
    vt_esc_ofg = DS_VT_ESC_OFG
    vt_ace_ofg = DS_VT_ACE_OFG
    vt_esc_oce = DS_VT_ESC_OCE
    vt_ace_oce = DS_VT_ACE_OCE
    nt_ger float = NT_GER
    nt_fg float = NT_FG
    nt_obj_fg float = NT_OBJ_FG
    nt_dis_fg float = NT_DIS_FG
    nt_ce float = NT_CE
    nt_obj_ce float = NT_OBJ_CE
    nt_dis_ce float = NT_DIS_CE
    nt_fg_d1 float = NT_FG_D1
    nt_fg_d1_pt float = NT_FG_D1_PT
    nt_fg_d1_ct float = NT_FG_D1_CT
    nt_fg_d2 float = NT_FG_D2
    nt_fg_d2_pt float = NT_FG_D2_PT
    nt_fg_d2_ct float = NT_FG_D2_CT
    nt_ce_d1 float = NT_CE_D1
    nt_ce_d2 float = NT_CE_D2
    nt_ce_d3 float = NT_CE_D3
    tp_sfg_d1 int = TP_SFG_D1
    tp_sfg_d2 int = TP_SFG_D2
    tp_sce_d1 int = TP_SCE_D1
    tp_sce_d2 int = TP_SCE_D2
    tp_sce_d3 int = TP_SCE_D3
    co_rs_i1 = CO_RS_I1
    co_rs_i2 = CO_RS_I2
    co_rs_i3 = CO_RS_I3
    co_rs_i4 = CO_RS_I4
    co_rs_i5 = CO_RS_I5
    co_rs_i6 = CO_RS_I6
    co_rs_i7 = CO_RS_I7
    co_rs_i8 = CO_RS_I8
    co_rs_i9 = CO_RS_I9
    """
)

SILVER_TYPES = {**STUDENT_FILE.types, **COURSE_FILE.types}
REQUIRED = ("ano", "co_ies", "co_curso", "co_grupo", "tp_pres", "nt_ger")
KEYS = ("co_ies", "ano", "co_curso")

# Questions QE_I01 to QE_I26 are in the files 7 to 32 of a year.
QUESTIONS = {f"QE_I{i:02d}": i + 6 for i in range(1, 27)}
# The letters of the published answer lists.
ANSWERS = tuple("ABCDEFGHIJK")
