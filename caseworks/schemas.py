"""Column lists and explicit schemas of the raw tables."""

from __future__ import annotations


def _names(text: str) -> list[str]:
    return text.split()


# Columns of the beneficiary snapshot, in order.
BENEF_COLUMNS = _names("""
    id_benef civilite nom prenom ide tel1 tel2 email commentaire agence conseiller telconseiller mailconseiller
    referent id_ref_principal numero_commande date_demarrage date_debut_csp date_fin_csp date_fin_theo date_fin_prest
    lot site id_site organisme adresse_benef cp_benef ville_benef insee_adresse statut situation suivi date_naissance
    nom_naissance info_adh date_dern_modif util_dern_modif id_util_dern_modif date_crea util_crea id_util_crea nir
    groupe util_exclu_factu date_exclu_factu jobready web_100 cdp cdp_util cdp_placement acc_deld
    emargement_impossible prime modalite_accompagnement _extracted_at
""")

# Columns of the appointment snapshot, in order.
RDV_COLUMNS = _names("""
    id_benef id_rdv date_deb date_fin type typage objet referent id_referent site id_site present motif_absence theme
    module dispo_rdv commentaire date_dern_modif util_dern_modif id_util_dern_modif date_crea util_crea id_util_crea
    mode_rdv signature_envoi signature_benef precision_rdv _extracted_at
""")

# Columns of the entity list, in order.
ENTITY_COLUMNS = _names("""
    Date_Fin_Prevue Diplome Date_Debut_Prevue Tronc_Commun Pilote Referent Libelle_Lieu_Site Specialite Reference
    Inscription_En_Ligne Libelle_Court Code_Analytique IDLieu_Site Fin Debut Libelle_Lieu Libelle CSecteur
    Objectif_General ID Libelle_Lieu_Court
""")

# Headers of the regional bonus files, in order.
BONUS_LINE_COLUMNS = [
    "Région de la commande", "LC", "Numero de commande", "Type de prestation", "Numéro du lot", "Intitulé du lot",
    "Numéro de marché", "Date de debut", "Date de fin", "SIRET Prestataire", "Raison sociale prestataire",
    "SIRET Titulaire", "Raison sociale titulaire", "Identifiant local", "Resultat déclaré", "Statut de la prestation",
    "Libelle du statut de la prestation", "Date de dernier statut", "DPAE", "DSN", "Situation DE", "Niveau d'alerte",
    "Statut du contrôle", "Resultat du contrôle", "Montant facturé", "Réfaction", "Certificat émis",
    "Date détection prime", "Date détection complément",
]

# Columns of the compiled bonus sheet; two get a new name.
COMPILED_BONUS_COLUMNS = {
    name: {"referent": "CIP", "date_entree": "Date_d_entr__e"}.get(name, name)
    for name in _names("""
        Lot Site LC referent Date_sortie date_entree Date_primes Montant_prime Motif Statut Date_RGLT RGLT
        MOIS_DEMARRAGE ANNEE_DEMARRAGE ANNE_PRIME MOIS_PRIME
    """)
}

# Enrolment columns at the root, then per person as {output suffix: field}.
ENROLMENT_ROOT = _names("""
    Code_Analytique_Parcours Type_Region Code_Region Libelle_Court_Parcours Libelle_Parcours_Groupe ID
    Libelle_Parcours IDAction CIR Date_Entree Convention Date_Sortie Type_apprentissage IDParcours_Groupe
    Date_Sortie_Previsionnelle
""")
CONTACT_FIELDS = {
    "email_pro": "Email_Pro", "telephone_pro": "Telephone_Pro", "mobile_pro": "Mobile_Pro",
    "email_perso": "Email_Perso", "telephone_perso": "Telephone_Perso", "mobile_perso": "Mobile_Perso",
}
ADDRESS_FIELDS = {
    "adresse_id": "ID", "adresse_internal_id": "_id", "numero_rue": "NumRue", "adresse_ligne1": "Adr1",
    "adresse_ligne2": "Adr2", "adresse_ligne3": "Adr3", "adresse_ligne4": "Adr4", "code_postal": "Code_Postal",
    "code_insee": "Code_Insee", "ville": "Ville", "arrondissement": "Arrondissement", "pays": "Pays",
}
TRAINER_FIELDS = {
    "formateur_id": "ID", "formateur_internal_id": "_id", "individu_id": "ID_Individu", "civilite": "Civilite",
    "nom": "Nom", "prenom": "Prenom", "nom_jeune_fille": "NomJF", "date_naissance": "Date_Naissance",
}
TRAINEE_FIELDS = {
    "stagiaire_id": "ID", "stagiaire_internal_id": "_id", "individu_id": "ID_Individu", "reference": "Reference",
    "civilite": "Civilite", "nom": "Nom", "prenom": "Prenom", "nom_naissance": "Nom_Naissance",
    "date_naissance": "Date_Naissance", "identifiant_utilisateur": "Identifiant_Utilisateur",
    "charge_affaires": "Charge_Affaires",
}


def _person(prefix: str, parent: str, own: dict[str, str]) -> dict[str, str]:
    flat = {f"{prefix}_{name}": f"{parent}.{field}" for name, field in (own | CONTACT_FIELDS).items()}
    return flat | {f"{prefix}_{name}": f"{parent}.Adresse.{field}" for name, field in ADDRESS_FIELDS.items()}


ENROLMENT_FIELDS = (
    {name: name for name in ENROLMENT_ROOT}
    | _person("fr", "formateur_referent", TRAINER_FIELDS)
    | _person("stg", "stagiaire", TRAINEE_FIELDS)
)

PARTY_TYPE = "struct<ID:string,_id:string,Nom:string,Reference:string>"
CONVENTION_TYPE = (
    "struct<_id:string,ID:string,IDSociete:string,Libelle:string,Libelle2:string,Reference:string,"
    f"Numero_interne:string,Numero_financeur:string,Client:{PARTY_TYPE},Financeur:{PARTY_TYPE}>"
)

_TRAINEE = (
    "struct<`$id`:string,ID:bigint,ID_Individu:bigint,Reference:string,Civilite:string,Nom:string,Prenom:string>"
)
# Convention, Salles and Materiels are read as text: the JSON reader keeps the raw text of an object or
# array, so one type fits every company.
_ENROLMENT = (
    f"struct<`$id`:string,ID:bigint,Stagiaire:{_TRAINEE},Date_Entree:string,Date_Sortie:string,"
    "IDParcours_Groupe:bigint,Libelle_Parcours_Groupe:string,Libelle_Court_Parcours_Groupe:string,"
    "Libelle_Parcours:string,Libelle_Court_Parcours:string,Code_Analytique_Parcours:string,Code_Region:string,"
    "Type_Region:string,Convention:string>"
)
_SLOT = (
    "struct<`$id`:string,Debut:string,Duree:string,Fin:string,Type_Seance:bigint,Libelle_Type_Seance:string,"
    "Debut_Absence:string,Duree_Absence:string,Fin_Absence:string,IDTypAbsen:string,LTypAbsen:string,"
    "Libelle_Court:string,Libelle:string,Module_Prevu:string,Personnalisee:string,Distancielle:boolean,"
    f"Seance_Action_Principale:boolean,Inscrit:{_ENROLMENT},Signature:string>"
)
_TRAINER = (
    "struct<`$id`:string,ID:bigint,Reference:string,Civilite:string,Nom:string,Prenom:string,Signature:string>"
)

# The session document as the service sends it, before its field names are cleaned.
SESSION_SCHEMA = (
    "`$id` string, ID string, Date timestamp_ntz, Debut string, Duree string, Fin string, IDModule bigint, "
    "IDAction bigint, Libelle_Court string, Libelle string, Libelle_Action string, Couleur string, "
    "Visibilite_stagiaire boolean, IDLieu bigint, Libelle_Lieu string, "
    f"Seances_Persos array<{_SLOT}>, Salles string, Materiels string, Intervenants array<{_TRAINER}>"
)
