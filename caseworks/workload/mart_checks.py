"""Check SQL for the decision tables: the plain definition of each, for DuckDB.

These are written from the definition (joins, then grouping, then whole-partition windows) and share
no step with the Spark plans, which aggregate early and rank in two levels.
"""

from __future__ import annotations

from caseworks.workload import domain


def finish(sql: str, days: str = "", money: str = "", tables: bool = True) -> str:
    """Days as text and money in its exact form, as the queries return them; the raw tables as WITH list."""
    casts = [f"CAST({c} AS VARCHAR) AS {c}" for c in days.split()]
    casts += [f"{domain.exact(c)} AS {c}" for c in money.split()]
    star = f"* REPLACE ({', '.join(casts)})" if casts else "*"
    head = f"WITH {domain.check_tables()} " if tables else ""
    return f"{head}SELECT {star} FROM ({sql}) AS checked"


def _in(*labels: str) -> str:
    return "(" + ", ".join("'" + label.replace("'", "''") + "'" for label in labels) + ")"


f = domain.flags
OPEN = _in(f.COMPLETED, f.LEFT_EARLY, f.ONGOING)
MARCHE = "split_part(lot, ' ', 1)"
REST = "CASE WHEN contains(lot, ' ') THEN trim(lot[instr(lot, ' ') + 1:]) ELSE trim(lot) END"
ACTIVE = f"CASE WHEN statut IN {_in(f.DROPPED, f.NO_SHOW)} THEN 0 ELSE 1 END"
JOINED = f"CASE WHEN statut IN {OPEN} THEN 1 WHEN statut IN {_in(f.NOT_JOINED)} THEN 0 END"
NOT_JOINED = f"CASE WHEN statut IN {OPEN} THEN 0 WHEN statut IN {_in(f.NOT_JOINED)} THEN 1 END"
WHO = "id_benef, nom, ide, agence, conseiller, referent, id_ref_principal, date_demarrage, date_fin_theo, date_fin_prest"
LATE = f"situation IN {_in(f.LONG_JOB)}"
DONE = f"statut IN {_in(f.COMPLETED)}"
EARLY = f"statut IN {_in(f.LEFT_EARLY)}"
WORK = "(situation LIKE 'Reprise%' OR situation LIKE 'Retour%')"


def _lot(i: int) -> str:
    return f"string_split(lot, ' ')[{i}]"


CLASSIFIED = f"""
SELECT {WHO}, {_lot(1)} AS marche, {_lot(2)} AS region, {_lot(3)} AS lot_unique, {REST} AS lot_sans_action,
  site, id_site, organisme, statut, situation, {ACTIVE} AS activite, {JOINED} AS adhesion, {NOT_JOINED} AS non_adhere,
  CASE WHEN statut NOT IN {_in(f.DROPPED, f.CANCELLED)} THEN 1 END AS oriente,
  CASE WHEN {DONE} THEN 1 END AS prime,
  CASE WHEN ({EARLY} AND situation LIKE 'Reprise%' AND situation NOT IN {_in(f.SHORT_JOB)}) OR situation LIKE 'Retour%'
    THEN 1 END AS sortie_anticipee_rep_emploi,
  CASE WHEN {DONE} AND {WORK} THEN 1 END AS Prestation_aboutie_rep_emploi,
  CASE WHEN {DONE} AND situation NOT IN {_in(f.SHORT_JOB, f.BACK_TO_WORK, f.LASTING_JOB, f.LONG_JOB)}
    THEN 1 END AS Prestation_aboutie,
  CASE WHEN ({DONE} OR {EARLY}) AND {LATE} THEN 1 END AS retour_emploi,
  CAST(date_fin_prest IS NULL AS INTEGER) AS portefeuille,
  CASE WHEN {EARLY} THEN 1 ELSE 0 END AS sortie_anticipee,
  CASE WHEN {EARLY} AND NOT {LATE} THEN 1 ELSE 0 END AS sorties_anticipees_hors_sorties_positives,
  CASE WHEN statut NOT IN {_in(f.DROPPED, f.CANCELLED, f.NO_SHOW)} THEN 1 ELSE 0 END AS recu,
  CAST(strftime(date_demarrage, '%Y%m') AS BIGINT) AS annee_mois_sort
FROM benef"""

PRESENCE = (
    "CASE present WHEN 1 THEN 'present' WHEN 0 THEN 'absent' WHEN 2 THEN 'annulé' "
    "ELSE CASE WHEN present IS NULL THEN 'a catégoriser' ELSE '' END END"
)
TYPAGE = (
    "CASE WHEN lower(typage) IN ('entretien de diagnostic', 'entretien de validation') "
    "THEN 'Entretien de Diagnostic' ELSE typage END"
)
MINUTES = "date_sub('minute', date_deb, date_fin)"
SEEN = f"""
SELECT r.id_benef, r.date_deb, r.date_fin, r.type, {TYPAGE} AS typage, r.referent, r.id_referent, r.site, r.id_site,
  {PRESENCE} AS presence, r.precision_rdv, b.lot, b.organisme, b.statut, b.situation, b.suivi
FROM rdv r LEFT JOIN benef b USING (id_benef)"""
DAY_TIMES = "strftime(date_deb, '%Y-%m-%d %H:%M:%S') AS date_deb, strftime(date_fin, '%Y-%m-%d %H:%M:%S') AS date_fin"
WORKED = f"CASE WHEN presence = 'present' THEN {MINUTES} ELSE 0 END AS tps_travail_ref"
BY_BENEF = f"""
SELECT count(id_benef) AS nb_de_personne_presente, id_benef, date_deb, date_fin, type, typage, referent, id_referent,
  site, id_site, presence, {REST} AS lot_sans_action, {_lot(1)} AS marche, lot, organisme, {WORKED}, statut, situation,
  precision_rdv, suivi
FROM ({SEEN}) GROUP BY ALL"""
TIE_BREAK = ", ".join(
    f"s.{c} NULLS FIRST" for c in (
        "date_fin", "type", "typage", "id_referent", "site", "id_site", "code", "precision_rdv",
    )
).replace(
    "s.code",
    "CASE s.presence WHEN '' THEN -1 WHEN 'absent' THEN 0 WHEN 'present' THEN 1 WHEN 'annulé' THEN 2 END",
)
PAIR = "PARTITION BY s.referent, s.id_benef ORDER BY"
RANKS = f"""
  {MINUTES} AS tps_travail_prevu, s.tps_travail_ref / 60 AS tps_travail_reel_heure,
  {MINUTES} / 60 AS tps_travail_prevu_heure,
  row_number() OVER ({PAIR} s.date_deb NULLS FIRST, {TIE_BREAK}) AS rang_entree,
  CASE WHEN b.date_fin_prest IS NOT NULL THEN row_number() OVER
    ({PAIR} b.date_fin_prest NULLS FIRST, s.date_deb NULLS FIRST, {TIE_BREAK}) END AS rang_sortie,
  b.date_fin_prest, CAST(strftime(s.date_deb, '%Y%m') AS BIGINT) AS annee_mois_sort"""
CLEAN = "SELECT p.* EXCLUDE (CIP, Date_d_entr__e), p.CIP AS referent, p.Date_d_entr__e AS date_entree, b.id_benef " \
    "FROM bonus_sheet p LEFT JOIN benef b ON b.numero_commande = p.LC"
REGION_LINES = """
SELECT "Numéro du lot" AS lot_unique,
  CASE WHEN regexp_matches("Intitulé du lot", 'CVL|IDF|GUAD') THEN string_split("Intitulé du lot", ' ')[3]
    WHEN contains("Intitulé du lot", 'GDEST') THEN 'GE' END AS region,
  "Numéro de marché" AS numero_marche, "Date de debut" AS date_deb, "Date de fin" AS date_fin,
  "Raison sociale titulaire" AS organisme, "Identifiant local" AS id_local, "Resultat déclaré" AS resultat_declare,
  "Statut de la prestation" AS statut_presta, "Libelle du statut de la prestation" AS lib_statut_presta,
  "Date de dernier statut" AS date_der_statut, DPAE, DSN, "Situation DE" AS situation_DE,
  "Montant facturé" AS montant_facture, "Réfaction" AS refaction, "Certificat émis" AS certificat_emis,
  "Date détection prime" AS date_detection_prime, "Date détection complément" AS date_detection_complement,
  "Numero de commande" AS numero_de_commande, LC, b.id_benef
FROM bonus_files LEFT JOIN benef b ON b.numero_commande = LC"""
STEERED = f"""
SELECT c.* EXCLUDE (sorties_anticipees_hors_sorties_positives), p.date_detection_prime,
  CASE WHEN c.retour_emploi = 1 OR p.date_detection_prime >= DATE '2021-01-01' THEN 1 ELSE 0 END AS retour_emploi_env_semap
FROM ({CLASSIFIED}) c LEFT JOIN ({REGION_LINES}) p USING (id_benef)"""
OWNER = "id_benef, referent, date_demarrage, date_fin_prest, marche, region, lot_unique, organisme, statut, situation, site"
REVENUE = f"""
SELECT s.*, i.type_facture, i.date_facture, i.montant_HT, i.montant_TVA, i.num_facture
FROM (SELECT DISTINCT {OWNER} FROM ({STEERED})) s
LEFT JOIN (SELECT facture.* FROM facture LEFT JOIN benef USING (id_benef)) i USING (id_benef)"""
TOTALS = (
    "max(date_facture) AS date_facture, max(region) AS region, sum(montant_HT) AS CA_HT_total, "
    "sum(montant_TVA) AS CA_TVA_total"
)
SPREAD = f"""
WITH per_benef AS (SELECT id_benef, {TOTALS} FROM ({REVENUE}) GROUP BY id_benef),
spread AS (
  SELECT v.*, t.date_facture, t.region,
    CAST(t.CA_HT_total AS DOUBLE) / count(*) OVER (PARTITION BY v.id_benef) AS CA_HT_par_rdv,
    CAST(t.CA_TVA_total AS DOUBLE) / count(*) OVER (PARTITION BY v.id_benef) AS CA_TVA_par_rdv
  FROM ({BY_BENEF}) v LEFT JOIN per_benef t USING (id_benef) WHERE v.id_benef <> 0),
ranked AS (SELECT s.*, {RANKS} FROM spread s LEFT JOIN benef b USING (id_benef))
SELECT k.*, CASE k.rang_entree WHEN 1 THEN p.Montant_prime ELSE 0 END AS Montant_prime, p.Date_primes
FROM ranked k LEFT JOIN ({CLEAN}) p USING (id_benef)"""

PEOPLE_ADHESION = f"""{WHO}, {_lot(1)} AS marche, lot, {REST} AS lot_sans_action, site, id_site, organisme, statut, situation"""

SESSION_LINES = """
SELECT c.conv_id, c.turn, c.role, u.n - 1 AS i, pieces[u.n] AS line
FROM (SELECT *, string_split(text, chr(10)) AS pieces FROM conversations) c, unnest(range(1, len(pieces) + 1)) AS u(n)"""
TRAINERS = """
SELECT l.*, k.copy, l.conv_id % 30 + 100 * k.copy AS trainer
FROM lines l JOIN (VALUES (0), (1)) AS k(copy) ON k.copy = 0 OR l.turn % 4 = 3 WHERE l.role <> 'system'"""

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


# Every column of the flattened attendance: text, numbers and dates as the source's nested fields give them.
ATTENDANCE = f"""
WITH lines AS ({SESSION_LINES}), met AS ({TRAINERS}), agreed AS (SELECT *, conv_id % 3 <> 1 AS agreement FROM met)
SELECT '[]' AS materiels, line AS seance_libelle, 'L' || (i % 5) AS seance_libelle_court, CAST(i AS VARCHAR) AS seance_internal_id,
  '' AS module_prevu, CAST(i % 3 AS VARCHAR) AS type_seance, 'TYPE' || (i % 3) AS libelle_type_seance,
  lpad(CAST(length(line) % 8 AS VARCHAR), 2, '0') || ':' || lpad(CAST(length(line) % 60 AS VARCHAR), 2, '0') || ':00' AS duree_seance,
  '09:00:00' AS heure_debut, '17:00:00' AS heure_fin_seance, i % 2 = 1 AS distancielle, 'NON' AS personnalisee,
  true AS seance_action_principale, CAST(NULL AS VARCHAR) AS signature, '' AS type_absence_libelle,
  CASE WHEN i % 4 = 0 THEN CAST(i AS BIGINT) END AS type_absence_id,
  CASE i % 2 WHEN 0 THEN '00:30:00' ELSE '00:00:00' END AS duree_absence,
  CAST(NULL AS VARCHAR) AS debut_absence, CAST(NULL AS VARCHAR) AS fin_absence,
  conv_id * 10 + turn AS inscription_id, '1' AS inscription_internal_id, 'REGION' AS type_region, '11' AS code_region,
  'PARCOURS' || (conv_id % 4) AS libelle_parcours, 'P' || (conv_id % 4) AS libelle_court_parcours,
  'PG' AS libelle_parcours_groupe, 'PG' || (conv_id % 6) AS libelle_court_parcours_groupe,
  'CA' || (conv_id % 9) AS code_analytique_parcours, conv_id % 6 AS id_parcours_groupe,
  '2024-01-02' AS date_entree, '2024-12-31' AS date_sortie, conv_id AS stagiaire_id, '2' AS stagiaire_internal_id,
  conv_id + 5 AS stagiaire_individu_id, 'ST' || conv_id AS stagiaire_reference, 'Mme' AS stagiaire_civilite,
  'NOM' || conv_id AS stagiaire_nom, 'PRENOM' || turn AS stagiaire_prenom,
  CASE WHEN agreement THEN conv_id END AS convention_id, CASE WHEN agreement THEN '7' END AS convention_internal_id,
  CAST(NULL AS BIGINT) AS convention_id_societe, CASE WHEN agreement THEN 'CONV' END AS convention_libelle,
  CAST(NULL AS VARCHAR) AS convention_libelle2, CAST(NULL AS VARCHAR) AS convention_reference,
  CAST(NULL AS VARCHAR) AS convention_numero_interne, CAST(NULL AS VARCHAR) AS convention_numero_financeur,
  CASE WHEN agreement THEN turn END AS client_id, CAST(NULL AS VARCHAR) AS client_internal_id,
  CASE WHEN agreement THEN 'CLIENT' END AS client_nom, CAST(NULL AS VARCHAR) AS client_reference,
  CAST(NULL AS BIGINT) AS financeur_id, CAST(NULL AS VARCHAR) AS financeur_internal_id,
  CASE WHEN agreement THEN 'FIN' END AS financeur_nom, CAST(NULL AS VARCHAR) AS financeur_reference,
  '[]' AS salles, conv_id % 12 AS id_lieu, turn % 2 = 0 AS visibilite_stagiaire, 'ACTION ' || role AS libelle_action,
  conv_id AS id_action, '17:00:00' AS source_fin, 'S' || (conv_id % 10) AS source_libelle_court, '07:00:00' AS source_duree,
  'LIEU' || (conv_id % 12) AS source_libelle_lieu, 'SESSION ' || conv_id AS source_libelle, trainer AS intervenant_id,
  CAST(3 + copy AS VARCHAR) AS intervenant_internal_id, 'R' || (copy + 1) AS intervenant_reference, 'M' AS intervenant_civilite,
  'TRAINER' || trainer AS intervenant_nom, CASE copy WHEN 0 THEN 'A' ELSE 'B' END AS intervenant_prenom,
  CAST(NULL AS VARCHAR) AS intervenant_signature, '09:00:00' AS source_debut, conv_id % 40 AS id_module,
  {STAMP.format("TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 365 AS INTEGER)) + to_hours(turn)")} AS date_date,
  conv_id || '-' || turn AS source_id, 'Presence_Soc_' || (conv_id % 3 + 2) AS source_table
FROM agreed"""


def enrolment_sql(without_trainer: bool = False) -> str:
    """All enrolment columns: those the mapping fills, NULL for the others. Rows without a trainer only if asked for."""
    from caseworks.schemas import ENROLMENT_FIELDS

    key = "CAST(c_nationkey AS VARCHAR)"
    known = {
        "Code_Analytique_Parcours": f"'CA' || {key}", "Type_Region": "'REGION'", "Code_Region": key,
        "Libelle_Court_Parcours": "c_mktsegment", "ID": "c_custkey", "Libelle_Parcours": "c_mktsegment",
        "IDAction": "c_custkey % 9", "IDParcours_Groupe": "c_custkey % 6",
        "Date_Entree": STAMP.format("TIMESTAMP '2024-01-01 08:30:00' + to_days(CAST(c_custkey % 300 AS INTEGER))"),
        "Date_Sortie_Previsionnelle": "'2025-06-30 00:00:00'",
        "fr_formateur_id": "c_custkey % 17", "fr_formateur_internal_id": "'5'", "fr_individu_id": "c_custkey % 17 + 1000",
        "fr_civilite": "'M'", "fr_nom": "'TRAINER' || CAST(c_custkey % 17 AS VARCHAR)", "fr_prenom": "'A'",
        "stg_stagiaire_id": "c_custkey", "stg_stagiaire_internal_id": "'6'", "stg_individu_id": "c_custkey + 5",
        "stg_reference": "c_mktsegment", "stg_civilite": "'Mme'", "stg_nom": "c_name", "stg_prenom": "'B'",
    }
    for person in ("fr", "stg"):
        known |= {
            f"{person}_adresse_id": "CAST(c_nationkey AS BIGINT)", f"{person}_adresse_internal_id": "'9'",
            f"{person}_numero_rue": "CAST(c_custkey % 100 AS VARCHAR)", f"{person}_ville": f"'VILLE' || {key}",
            f"{person}_pays": "'FR'",
        }
    if without_trainer:
        known |= {c: f"CASE WHEN c_custkey % 5 <> 0 THEN {expr} END" for c, expr in known.items() if c.startswith("fr_")}
    columns = ", ".join(f"{known.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in ENROLMENT_FIELDS)
    return f"SELECT {columns} FROM customer" + ("" if without_trainer else " WHERE c_custkey % 5 <> 0")


def mart_sql() -> dict[str, str]:
    days = "date_demarrage date_fin_prest"
    return {
        "mrt_activite": finish(
            f"""SELECT id_benef, numero_commande, date_demarrage, date_fin_prest, date_fin_theo, marche, lot_sans_action,
              organisme, site, statut, situation, referent, CAST(sum(a) AS BIGINT) AS activite,
              CAST(sum(j) AS BIGINT) AS adhesion, CAST(sum(n) AS BIGINT) AS non_adhere
            FROM (SELECT *, {MARCHE} AS marche, {REST} AS lot_sans_action, {ACTIVE} AS a, {JOINED} AS j, {NOT_JOINED} AS n
              FROM benef) WHERE marche IN ('ATC', 'ATR', 'ESPR') GROUP BY ALL""",
            days=f"{days} date_fin_theo",
        ),
        "mrt_adhesion": finish(
            f"""SELECT {PEOPLE_ADHESION}, {ACTIVE} AS activite, {JOINED} AS adhesion, {NOT_JOINED} AS non_adhere,
              CASE WHEN statut IN {_in(f.COMPLETED, f.LEFT_EARLY, f.ONGOING, f.INVITED, f.DROPPED, f.NO_SHOW_LOWER)}
                THEN 1 END AS oriente,
              CASE WHEN statut IN {_in(f.COMPLETED, f.LEFT_EARLY, f.ONGOING, f.INVITED, f.DROPPED)} THEN 1 END AS recu,
              CASE WHEN {DONE} THEN 1 END AS prime FROM benef""",
            days=f"{days} date_fin_theo",
        ),
        "mrt_adv_facture": finish(
            f"""SELECT v.*, c.* EXCLUDE (id_benef),
              date_diff('day', c.date_fin_prest, v.date_facture) AS nb_jour_fin_presta_paiment
            FROM facture v FULL JOIN (SELECT {PEOPLE_ADHESION}, util_exclu_factu, date_exclu_factu, {ACTIVE} AS activite,
              {JOINED} AS adhesion, {NOT_JOINED} AS non_adhere FROM benef) c ON c.id_benef = v.id_benef""",
            days=f"{days} date_fin_theo date_facture date_exclu_factu", money="montant_HT montant_TVA",
        ),
        "mrt_benef_ca_prime": finish(
            f"""SELECT t.*, p.Montant_prime, p.Date_primes FROM (
              SELECT id_benef, referent, date_demarrage, date_fin_prest, marche, lot_unique, organisme, statut, situation,
                site, {TOTALS} FROM ({REVENUE}) GROUP BY ALL) t LEFT JOIN ({CLEAN}) p USING (id_benef)""",
            days=f"{days} date_facture Date_primes", money="CA_HT_total CA_TVA_total Montant_prime",
        ),
        "mrt_facture": finish(
            """SELECT v.*, b.agence, b.conseiller, b.referent, b.numero_commande, b.date_demarrage, b.date_fin_prest
            FROM facture v LEFT JOIN benef b USING (id_benef)""",
            days=f"{days} date_facture", money="montant_HT montant_TVA",
        ),
        "mrt_formateur_portefeuille": finish(
            f"""SELECT referent, marche, region, lot_unique, site, statut, count(*) AS candidats_en_portefeuille
            FROM ({STEERED}) WHERE date_fin_prest IS NULL AND statut = '{f.ONGOING}' GROUP BY ALL"""
        ),
        "mrt_pilotage": finish(
            f"""SELECT c.*,
              CASE WHEN c.retour_emploi = 1 OR p.Date_primes >= DATE '2021-01-01' THEN 1 ELSE 0 END
                AS retour_emploi_env_semap, p.Montant_prime, p.Date_primes
            FROM ({CLASSIFIED}) c LEFT JOIN (
              SELECT id_benef, Montant_prime, Date_primes FROM ({SPREAD}) WHERE Montant_prime > 1
              QUALIFY row_number() OVER (PARTITION BY id_benef ORDER BY Date_primes NULLS FIRST, Montant_prime) = 1) p
            USING (id_benef)""",
            days=f"{days} date_fin_theo Date_primes", money="Montant_prime",
        ),
        "mrt_presence": finish(
            f"""WITH lines AS ({SESSION_LINES}), met AS ({TRAINERS})
            SELECT 'L' || (i % 5) AS type_seance, 'TYPE' || (i % 3) AS libelle_type_seance,
              CAST(length(line) % 8 * 60 + length(line) % 60 AS BIGINT) AS duree_seance_minutes,
              (length(line) % 8 * 60 + length(line) % 60) / 60 AS duree_seance_heures,
              lpad(CAST(length(line) % 8 AS VARCHAR), 2, '0') || ':' || lpad(CAST(length(line) % 60 AS VARCHAR), 2, '0')
                || ':00' AS duree_seance,
              '09:00:00' AS heure_debut, '17:00:00' AS heure_fin_seance, i % 2 = 1 AS distancielle, 'NON' AS personnalisee,
              CASE i % 2 WHEN 0 THEN '00:30:00' ELSE '00:00:00' END AS duree_absence,
              CAST(CASE i % 2 WHEN 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS duree_absence_heures,
              CAST(NULL AS VARCHAR) AS debut_absence, CAST(NULL AS VARCHAR) AS fin_absence, 'REGION' AS type_region,
              'PARCOURS' || (conv_id % 4) AS libelle_parcours, 'P' || (conv_id % 4) AS libelle_court_parcours,
              'PG' || (conv_id % 6) AS libelle_court_parcours_groupe, 'CA' || (conv_id % 9) AS code_analytique_parcours,
              '2024-01-02' AS date_entree, '2024-12-31' AS date_sortie, conv_id AS stagiaire_id,
              'NOM' || conv_id AS stagiaire_nom, 'SESSION ' || conv_id AS source_libelle,
              'LIEU' || (conv_id % 12) AS source_libelle_lieu, trainer AS intervenant_id,
              'R' || (copy + 1) AS intervenant_reference, 'TRAINER' || trainer AS intervenant_nom,
              '09:00:00' AS source_debut, '17:00:00' AS source_fin, '07:00:00' AS source_duree, conv_id % 40 AS id_module,
              {STAMP.format("TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 365 AS INTEGER)) + to_hours(turn)")} AS date_date
            FROM met""",
            tables=False,
        ),
        "mrt_prime": finish(
            REGION_LINES, days="date_deb date_detection_prime", money="montant_facture"
        ),
        "mrt_rdv": finish(
            f"""SELECT * REPLACE ({DAY_TIMES}) FROM (
              SELECT count(id_benef) AS nb_de_personne_presente, date_deb, date_fin, type, typage, referent, id_referent,
                site, id_site, presence, {REST} AS lot_sans_action, {_lot(1)} AS marche, lot, organisme, {WORKED}
              FROM ({SEEN}) GROUP BY ALL)"""
        ),
        "mrt_rdv_detail": finish(
            f"""SELECT * REPLACE ({DAY_TIMES}) FROM (SELECT s.*, {RANKS}
              FROM ({BY_BENEF}) s LEFT JOIN benef b USING (id_benef) WHERE s.id_benef <> 0)""",
            days="date_fin_prest",
        ),
        "mrt_referent_Ca": finish(
            REVENUE, days=f"{days} date_facture", money="montant_HT montant_TVA"
        ),
        "mrt_referent_rdv_ca": finish(
            f"SELECT * REPLACE ({DAY_TIMES}) FROM ({SPREAD})",
            days="date_fin_prest date_facture Date_primes", money="Montant_prime",
        ),
        "BDD_BU_SECURE": finish(
            """SELECT BRANCHE, CODE_BU, BU_LIBELLE, ANNEE, MOIS, TYPE, RUBRIQUE_LIBELLE AS CODE_RUBRIQUE,
              CODE_RUBRIQUE AS RUBRIQUE_LIBELLE, VALEUR FROM business_units"""
        ),
        "inscrite_union": finish(enrolment_sql(), tables=False),
        "prime_union_region": finish(
            f"""SELECT * REPLACE (CAST("Date de debut" AS VARCHAR) AS "Date de debut",
              CAST("Date détection prime" AS VARCHAR) AS "Date détection prime",
              {domain.exact('"Montant facturé"')} AS "Montant facturé") FROM bonus_files"""
        ),
        "prime_clean": finish(CLEAN, days="Date_primes", money="Montant_prime"),
        "pilotage_flags": finish(STEERED, days=f"{days} date_fin_theo date_detection_prime"),
        "rdv_formateur": finish(f"SELECT * REPLACE ({DAY_TIMES}) FROM ({BY_BENEF})"),
    }
